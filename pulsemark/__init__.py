"""pulsemark: engagement analytics on Spark.

Poll snapshots in, channel-relative engagement features, profiles, splits and classifiers out.
Every step is a DataFrame-to-DataFrame function; Spark partitions, shuffles and spills the work.
"""
