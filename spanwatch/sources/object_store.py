"""Access to an S3-compatible object store through Spark's own settings."""

from __future__ import annotations

REGION = "eu-central-1"


def object_store_conf(key_id: str | None = None, secret: str | None = None) -> dict[str, str]:
    """Settings to build the session with.

    Without keys the default credentials chain applies (environment, instance role). Keys
    go into the session's settings, never into SQL text or paths.
    """
    conf = {"spark.hadoop.fs.s3a.endpoint.region": REGION}
    if key_id and secret:
        conf["spark.hadoop.fs.s3a.access.key"] = key_id
        conf["spark.hadoop.fs.s3a.secret.key"] = secret
    return conf
