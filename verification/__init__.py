"""The registered queries: driver tables shaped as raw retail files, the library's plans over
them, and the same results in plain SQL."""
