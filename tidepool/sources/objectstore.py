"""Object-store settings for file sources, as Hadoop options of one read.

File sources copy read options into the Hadoop configuration of that read, so these settings
hold for one source and leave the session alone.  Reading ``s3a://`` paths needs the S3A
connector jar on the classpath.
"""

from __future__ import annotations

import os
from typing import Any
from urllib.parse import urlsplit

# Credential keys of a spec -> S3A settings.
S3A_SETTINGS = {
    "aws_access_key_id": "access.key",
    "aws_secret_access_key": "secret.key",
    "aws_session_token": "session.token",
    "region_name": "endpoint.region",
}
# Environment variables that hold the same.
ENVIRONMENT = {
    "AWS_ACCESS_KEY_ID": "aws_access_key_id",
    "AWS_SECRET_ACCESS_KEY": "aws_secret_access_key",
    "AWS_SESSION_TOKEN": "aws_session_token",
    "AWS_REGION": "region_name",
    "S3_ENDPOINT_URL": "endpoint_url",
}
TEMPORARY_CREDENTIALS = "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"


def s3a_path(url: str) -> str:
    """The URL with Hadoop's scheme for S3 (other schemes unchanged)."""
    scheme, rest = url.split("://", 1) if "://" in url else ("", url)
    return f"s3a://{rest}" if scheme == "s3" else url


def environment_credentials() -> dict[str, str]:
    return {key: os.environ[name] for name, key in ENVIRONMENT.items() if os.environ.get(name)}


def _endpoint_settings(url: str) -> dict[str, str]:
    """A custom endpoint is addressed by path; without a scheme it is taken as plain HTTP."""
    parts = urlsplit(url if "://" in url else f"http://{url}")
    return {
        "endpoint": parts.netloc + parts.path.rstrip("/"),
        "path.style.access": "true",
        "connection.ssl.enabled": "true" if parts.scheme == "https" else "false",
    }


def s3a_options(credentials: dict[str, Any] | None) -> dict[str, str]:
    given = {k: str(v) for k, v in (credentials or {}).items() if v}
    settings = {S3A_SETTINGS[k]: v for k, v in given.items() if k in S3A_SETTINGS}
    if "session.token" in settings:
        settings["aws.credentials.provider"] = TEMPORARY_CREDENTIALS
    if "endpoint_url" in given:
        settings |= _endpoint_settings(given["endpoint_url"])
    return {f"fs.s3a.{name}": value for name, value in settings.items()}
