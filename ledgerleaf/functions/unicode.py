"""String functions that need Unicode tables or byte-exact cuts: Arrow-batched UDFs."""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MOST_KEY_BYTES = 200
_ESCAPED = re.compile(r"[/~%\x00-\x1f\x7f]")


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def comparable_name(text: pd.Series) -> pd.Series:
    """NFKC, without white space and symbols, upper case: two spellings of one product name become equal."""
    return text.map(lambda t: None if t is None else re.sub(r"[\W_]", "", unicodedata.normalize("NFKC", t)).upper())


@F.pandas_udf(StringType())
def html_unescaped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else html.unescape(t))


def encode_key(fields: list[str]) -> str:
    """A folder name of key fields: escapes in percent form, joined by a tilde; beyond 200 bytes cut at a whole
    character and closed by ``-h`` and 12 digits of the full key's SHA-256."""
    key = "~".join(_ESCAPED.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), f) for f in fields)
    raw = key.encode()
    if len(raw) <= MOST_KEY_BYTES:
        return key
    tail = "-h" + hashlib.sha256(raw).hexdigest()[:12]
    return raw[: MOST_KEY_BYTES - len(tail)].decode(errors="ignore") + tail


@F.pandas_udf(StringType())
def source_key(fields: pd.Series) -> pd.Series:
    return fields.map(lambda f: None if f is None else encode_key(list(f)))
