"""Readers and writers. Paths are Hadoop paths, so local, HDFS and object stores work alike."""
