"""Remove credentials from text, URL and nested columns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Secret query keys and the replacement text.
SECRET_KEYS = ("api-key", "apikey", "api_key", "key", "token", "access_token")
MASK = "REDACTED"
# Schemes whose empty authority is still written out.
_AUTHORITY_SCHEMES = ("http", "https", "ws", "wss", "ftp", "file")

_BLANK = r"\s\x1c-\x1f\x85\p{Z}"
_QUERY_SECRET = rf"(?iu)([?&](?:{'|'.join(SECRET_KEYS)})=)([^&#{_BLANK}\"']+)"
_PATH_SECRET = rf"(?iu)(/v2/)([^/?#{_BLANK}\"']+)"
_V2_TAIL = r"(?is)^(.*/v2/)([^/]+)\z"

# scheme, authority with its slashes, path, query, fragment
_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"


def redact_text(text: Column) -> Column:
    """Mask secret query values and ``/v2/<secret>`` anywhere in free text."""
    masked = F.regexp_replace(text, _QUERY_SECRET, f"$1{MASK}")
    return F.regexp_replace(masked, _PATH_SECRET, f"$1{MASK}")


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL, group)


def _scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def _authority(url: Column) -> Column:
    return F.substr(_part(url, 2), F.lit(3))


def _unquote(text: Column) -> Column:
    """Percent-decode; a stray percent sign stays as it is."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _query_items(url: Column) -> Column:
    """Query as an array of (key, value), in order, blank values kept."""
    items = F.filter(F.split(_part(url, 4), "&"), lambda item: item != "")
    return F.transform(
        items,
        lambda item: F.struct(
            _unquote(F.regexp_extract(item, r"(?s)^([^=]*)", 1)).alias("key"),
            _unquote(F.regexp_extract(item, r"(?s)^[^=]*=(.*)\z", 1)).alias("value"),
        ),
    )


def _is_secret(item: Column) -> Column:
    return F.lower(item["key"]).isin(*SECRET_KEYS)


def redact_url(url: Column) -> Column:
    """Mask a URL by its parts: secret query values, and the last path part after ``v2``."""
    items = F.transform(
        _query_items(url),
        lambda i: F.concat(
            i["key"], F.lit("="), F.when(_is_secret(i), F.lit(MASK)).otherwise(i["value"])
        ),
    )
    query = F.array_join(items, "&")
    path = F.regexp_replace(_part(url, 3), _V2_TAIL, f"$1{MASK}")
    bare = _scheme(url).isin(*_AUTHORITY_SCHEMES) & ((path == "") | path.startswith("/"))
    named = _authority(url) != ""
    return F.concat(
        F.when(_scheme(url) != "", F.concat(_scheme(url), F.lit(":"))).otherwise(""),
        F.when(named, _part(url, 2)).when(bare, "//").otherwise(""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(_part(url, 5) != "", F.concat(F.lit("#"), _part(url, 5))).otherwise(""),
    )


def known_secrets(urls: DataFrame, url: str = "url") -> list[tuple[str, str]]:
    """(find, replace) pairs of a table of configured URLs, in order of application.

    Longer texts go first, so that a secret inside another one leaves no rest of it. The URLs are
    configuration: their secrets come to the driver and travel with the plan.
    """
    col = F.col(url)
    values = F.transform(
        F.filter(_query_items(col), lambda i: _is_secret(i) & (i["value"] != "")),
        lambda i: F.struct(i["value"].alias("find"), F.lit(MASK).alias("replace")),
    )
    tail = F.regexp_extract(_part(col, 3), _V2_TAIL, 2)
    others = F.array(
        F.struct(tail.alias("find"), F.lit(MASK).alias("replace")),
        F.struct(col.alias("find"), redact_url(col).alias("replace")),
    )
    pairs = urls.filter(col != "").select(F.inline(F.concat(values, others)))
    found = pairs.filter("find <> ''").distinct().collect()
    ordered = sorted(found, key=lambda r: (-len(r["find"]), r["find"], r["replace"]))
    return [(r["find"], r["replace"]) for r in ordered]


def remove_known_secrets(text: Column, secrets: list[tuple[str, str]]) -> Column:
    """Replace each known secret wherever it occurs, one secret after the other."""
    pairs = [(find, mask) for find, mask in secrets if find]

    def clean(value: str) -> str:
        for find, mask in pairs:
            value = value.replace(find, mask)
        return value

    @F.arrow_udf("string")
    def remove(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else clean(t) for t in texts.to_pylist()], pa.string())

    return remove(text)


def redact_value(value: Column, kind: T.DataType) -> Column:
    """Mask every string inside a nested value; map keys and other types stay."""
    if isinstance(kind, T.StringType):
        return redact_text(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: redact_value(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _k, x: redact_value(x, kind.valueType))
    if isinstance(kind, T.StructType):
        fields = [redact_value(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def redact_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Mask whole columns of any type."""
    for name in columns:
        df = df.withColumn(name, redact_value(F.col(name), df.schema[name].dataType))
    return df


def url_problem(url: Column, websocket: bool = False) -> Column:
    """Why a URL may not be used for a live endpoint; null when it may."""
    expected = "wss" if websocket else "https"
    authority = _authority(url)
    host_port = F.regexp_extract(authority, r"(?s)([^@]*)\z", 1)
    bracketed = F.regexp_extract(host_port, r"\[([^\]]*)", 1)
    host = F.when(host_port.contains("["), bracketed).otherwise(
        F.regexp_extract(host_port, r"^([^:]*)", 1)
    )
    return (
        F.when(_scheme(url) != expected, f"URL must use {expected}://")
        .when(host == "", "URL must include a hostname")
        .when(authority.contains("@"), "URL must not use userinfo credentials")
    )
