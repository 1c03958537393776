"""Input schemas, readers for the feed files, and the shared working copy of a frame.

Tables are read and written with Spark's own sources (``spark.read.format(...)``,
``df.write.mode(...)``); only what fixes a layout lives here.
"""
