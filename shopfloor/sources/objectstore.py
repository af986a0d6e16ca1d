"""Object-store settings (S3A) as session configuration.

The caller supplies endpoint and credentials (from its own secret store);
this module only maps them to the Hadoop S3A keys.  Nothing is read from
the environment here.
"""

from __future__ import annotations


def s3a_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = True,
) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
