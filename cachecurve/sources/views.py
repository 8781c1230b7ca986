"""Files read under another name.

Spark picks the codec of a file by the end of its name, so a gzip file called ``x.gz.key2`` is
no gzip file to it. A Hadoop view file system with one regular-expression link for each store gives every file a second
name that ends in ``.gz``: ``viewfs://<view>/<path>.gz`` is ``<store>/<path>``. The link is a session
setting, so Spark opens the files with its own reader, credentials and split sizes, on any
store it has a file system for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_SUFFIX = ".gz"
_STORE = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?:///?(?=/|$)|//[^/]*(?=/)|(?=/))")
# Signs of a name that the target of a link, which is a URI, must have escaped.
_ESCAPED = "%", " ", "[", "]", "{", "}", "#", "?", "<", ">", "|", "^", "`", '"', "\\"


def store_of(uri: str) -> tuple[str, str]:
    """Scheme and authority of a file, as a link target has them, and its path."""
    found = _STORE.match(uri)
    if found is None:
        raise ValueError(f"not the full name of a file: {uri!r}")
    path = "/" + uri[found.end():].lstrip("/")
    store = found.group(0).rstrip("/")
    return (store + "//" if store.endswith(":") else store), path


def _rules() -> str:
    return ";".join(f"replaceresolveddstpath:{re.escape(sign)}:%{ord(sign):02X}" for sign in _ESCAPED)


def view_of(spark: SparkSession, store: str) -> str:
    """The view of a store, with its link set in this session."""
    view = "cachecurve-" + hashlib.md5(store.encode()).hexdigest()[:12]
    link = f"fs.viewfs.mounttable.{view}.linkRegex.{_rules()}#.^/(.+)\\{_SUFFIX}$"
    spark.conf.set(link, f"{store}/$1")
    return f"viewfs://{view}"


def as_gzip(spark: SparkSession, uris: Iterable[str]) -> Iterator[tuple[tuple[str, str], list[str]]]:
    """For each store the (view, store) and the names, escaped for Spark's readers, by
    which its files are gzip files."""
    by_store: dict[str, list[str]] = {}
    for uri in uris:
        store, path = store_of(uri)
        by_store.setdefault(store, []).append(path)
    for store, paths in by_store.items():
        view = view_of(spark, store)
        # a reader takes these signs for patterns
        yield (view, store), [re.sub(r"([\[\]{}*?\\])", r"\\\1", f"{view}{path}{_SUFFIX}")
                              for path in paths]


def listed_name(path: Column, view: tuple[str, str] | None = None) -> Column:
    """``_metadata.file_path`` spelled as a listing of the store spells it: without URI
    escapes and under the file's own name."""
    name = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    if view is not None:
        name = F.substr(name, F.lit(len(view[0]) + 1), F.length(name) - len(view[0]) - len(_SUFFIX))
        name = F.concat(F.lit(view[1]), name)
    return F.regexp_replace(name, "^file:/+", "file:/")
