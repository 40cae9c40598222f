"""PySpark jobs for auditing and garbage-collecting a content-addressed object store."""
