"""Content-engagement lake and warehouse as plain DataFrame functions.

``sources`` read, ``functions`` build columns, ``operators`` map DataFrames to
DataFrames, ``sinks`` write, ``plans`` chain them into jobs and ``streaming``
runs the same logic on file streams.
"""
