"""PyArrow file systems from the settings that Hadoop's have.

Spark opens most files itself, with credentials from its configuration. Tasks
that open an archive do so through PyArrow, which does not see that
configuration; here the driver reads the settings of a path's store, under the
names of Hadoop's connectors, and hands them to the tasks as arguments of the
PyArrow file system.

What has no counterpart is left to the environment of the executors: key files of
Google service accounts, credential providers of S3 other than keys, roles and
anonymous access, and keytabs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from urllib.parse import urlsplit

from pyarrow import fs
from pyspark.sql import SparkSession

Setting = Callable[[str], str | None]

#: Settings of Hadoop's S3 connector (after ``fs.s3a.``) and the arguments they become.
_S3 = {
    "access.key": "access_key",
    "secret.key": "secret_key",
    "session.token": "session_token",
    "endpoint.region": "region",
    "assumed.role.arn": "role_arn",
    "assumed.role.session.name": "session_name",
    "assumed.role.external.id": "external_id",
}
#: Settings of Hadoop's Google connector and the arguments they become.
_GOOGLE = {"fs.gs.project.id": "project_id", "fs.gs.storage.root.url": "endpoint_override"}
_TENANT = re.compile(r"https://[^/]+/([^/]+)/oauth2/")


def session_setting(spark: SparkSession) -> Setting:
    """How a session sees a Hadoop setting: from its own conf, else from the context's."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()

    def setting(name: str) -> str | None:
        for key in (name, f"spark.hadoop.{name}"):
            value = spark.conf.get(key, None)
            if value is not None:
                return value
        return hadoop.get(name)

    return setting


def _s3(bucket: str, setting: Setting) -> dict[str, object]:
    def of(name: str) -> str | None:  # a bucket's own setting comes first
        return setting(f"fs.s3a.bucket.{bucket}.{name}") or setting(f"fs.s3a.{name}")

    found: dict[str, object] = {argument: value for name, argument in _S3.items() if (value := of(name))}
    if endpoint := of("endpoint"):
        scheme, _, host = endpoint.rpartition("://")
        plain = (of("connection.ssl.enabled") or "true").lower() == "false"
        found |= {"endpoint_override": host, "scheme": scheme or ("http" if plain else "https")}
        found["force_virtual_addressing"] = (of("path.style.access") or "false").lower() != "true"
    if "Anonymous" in (of("aws.credentials.provider") or "") and "access_key" not in found:
        found["anonymous"] = True
    if proxy := of("proxy.host"):
        port = of("proxy.port") or "80"
        found["proxy_options"] = {"scheme": "http", "host": proxy, "port": int(port)}
    return found


def _azure(authority: str, setting: Setting) -> dict[str, object]:
    host = authority.rpartition("@")[2]
    account, _, domain = host.partition(".")
    container = authority.rpartition("@")[0]

    def of(name: str) -> str | None:  # an account's own setting comes first
        return setting(f"{name}.{host}") or setting(name)

    found: dict[str, object] = {"account_name": account}
    if domain and domain != "dfs.core.windows.net":
        found |= {"dfs_storage_authority": f".{domain}", "blob_storage_authority": f".{domain.replace('dfs.', 'blob.', 1)}"}
    client = of("fs.azure.account.oauth2.client.id")
    tenant = _TENANT.match(of("fs.azure.account.oauth2.client.endpoint") or "")
    if key := of("fs.azure.account.key"):
        found["account_key"] = key
    elif token := setting(f"fs.azure.sas.fixed.token.{container}.{host}") or of("fs.azure.sas.fixed.token"):
        found["sas_token"] = token.removeprefix("?")
    elif client and tenant:
        secret = of("fs.azure.account.oauth2.client.secret")
        found |= {"client_id": client, "client_secret": secret, "tenant_id": tenant.group(1)}
    return found


def _google(setting: Setting) -> dict[str, object]:
    found: dict[str, object] = {argument: value for name, argument in _GOOGLE.items() if (value := setting(name))}
    if (setting("fs.gs.auth.type") or "").upper() == "UNAUTHENTICATED":
        found["anonymous"] = True
    if endpoint := found.get("endpoint_override"):
        scheme, _, host = str(endpoint).rstrip("/").rpartition("://")
        found |= {"endpoint_override": host, "scheme": scheme or "https"}
    return found


def _hadoop(scheme: str, authority: str, setting: Setting) -> dict[str, object]:
    """Settings of a name service with several name nodes, which is no host."""
    extra = {}
    nodes = setting(f"dfs.ha.namenodes.{authority}") if authority else None
    if nodes:
        names = ["dfs.nameservices", f"dfs.ha.namenodes.{authority}", f"dfs.client.failover.proxy.provider.{authority}"]
        names += [f"dfs.namenode.rpc-address.{authority}.{node.strip()}" for node in nodes.split(",")]
        extra = {name: value for name in names if (value := setting(name))}
    host, _, port = authority.partition(":")
    found: dict[str, object] = {"host": f"{scheme}://{host}" if host else "default", "port": int(port or 0)}
    return found | ({"extra_conf": extra} if extra else {})


def store_root(path: str) -> tuple[str, str]:
    """Scheme and authority of a path; ``file`` for one without a scheme."""
    parts = urlsplit(path)
    return (parts.scheme or "file", parts.netloc) if ":" in path.split("/", 1)[0] else ("file", "")


def store_arguments(path: str, setting: Setting) -> dict[str, object]:
    """The arguments that a store's settings give to its PyArrow file system; none for local files."""
    scheme, authority = store_root(path)
    if scheme in ("s3", "s3a", "s3n"):
        return _s3(authority, setting)
    if scheme in ("abfs", "abfss"):
        return _azure(authority, setting)
    if scheme == "gs":
        return _google(setting)
    if scheme in ("hdfs", "viewfs"):
        return _hadoop(scheme, authority, setting)
    return {}


#: File system of each scheme, and how a path is named in it.
_SYSTEMS: dict[str, str] = {
    "s3": "S3FileSystem",
    "s3a": "S3FileSystem",
    "s3n": "S3FileSystem",
    "abfs": "AzureFileSystem",
    "abfss": "AzureFileSystem",
    "gs": "GcsFileSystem",
    "hdfs": "HadoopFileSystem",
    "viewfs": "HadoopFileSystem",
}


def store_path(path: str) -> str:
    """A path as its store's PyArrow file system names it."""
    scheme, authority = store_root(path)
    inner = urlsplit(path.replace("?", "%3F").replace("#", "%23")).path.replace("%3F", "?").replace("%23", "#")
    if scheme in ("abfs", "abfss"):
        return authority.rpartition("@")[0] + inner
    return inner if scheme in ("hdfs", "viewfs") else authority + inner


def open_store(path: str, arguments: Mapping[str, object]) -> fs.FileSystem:
    """The PyArrow file system of a path's store."""
    return getattr(fs, _SYSTEMS[store_root(path)[0]])(**arguments)
