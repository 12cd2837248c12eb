"""Masks and tokens for personal fields, and the policy that says which fields are personal. All JVM-side columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of personal fields, and patterns of such names
FIELDS = (
    "first_name last_name full_name name email phone phone_number address street ssn social_security_number license_number driver_license credit_card bank_account signed_by"
).split()
PATTERNS = [".*_name$", ".*email.*", ".*phone.*", ".*address.*", ".*ssn.*", ".*license.*"]


def _starred(word: Column, short: Column) -> Column:
    """First letter and stars; `short` for words of one letter or none."""
    return F.when(F.length(word) > 1, F.concat(F.substring(word, 1, 1), F.repeat(F.lit("*"), F.length(word) - 1))).otherwise(short)


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")


def mask_email(c: Column) -> Column:
    """a***@e******.c**; split at the last @."""
    local, domain = F.regexp_extract(c, r"(?s)^(.*)@([^@]*)$", 1), F.regexp_extract(c, r"(?s)^(.*)@([^@]*)$", 2)
    labels = F.transform(F.split(domain, r"\."), lambda w: _starred(w, F.lit("*")))
    return F.when(c.contains("@"), F.concat(F.substring(local, 1, 1), F.lit("***@"), F.array_join(labels, "."))).otherwise("***@***.***")


def mask_phone(c: Column) -> Column:
    """The last four digits."""
    digits = F.regexp_replace(c, r"(?U)\D", "")
    return F.when(F.length(digits) >= 4, F.concat(F.lit("***-***-"), F.substring(digits, -4, 4))).otherwise("***-***-****")


def mask_name(c: Column) -> Column:
    """First letter of each word; a blank text becomes empty."""
    return F.when(c == "", "***").otherwise(F.array_join(F.transform(_words(c), lambda w: _starred(w, w)), " "))


def mask_address(c: Column) -> Column:
    """First letters of the first three words."""
    words = F.transform(F.slice(_words(c), 1, 3), lambda w: _starred(w, F.lit("*")))
    return F.when(c == "", "*** **** ***").otherwise(F.concat(F.array_join(words, " "), F.lit(" ***")))


def mask_generic(c: Column) -> Column:
    """First and last letter; short texts all stars."""
    n = F.length(c)
    return F.when(n == 0, "***").when(n <= 3, F.repeat(F.lit("*"), n)).otherwise(F.concat(F.substring(c, 1, 1), F.repeat(F.lit("*"), n - 2), F.substring(c, -1, 1)))


def token(c: Column, key: bytes, salt: str = "") -> Column:
    """tok_ and 16 hex digits of HMAC-SHA256 over 'salt:value'; empty stays empty. One-way."""
    import hashlib

    block = hashlib.sha256(key).digest() if len(key) > 64 else key
    block = block.ljust(64, b"\0")
    pad = lambda x: F.lit(bytearray(b ^ x for b in block))
    inner = F.unhex(F.sha2(F.concat(pad(0x36), F.encode(F.concat(F.lit(f"{salt}:"), c), "UTF-8")), 256))
    return F.when(c == "", "").otherwise(F.concat(F.lit("tok_"), F.substring(F.sha2(F.concat(pad(0x5C), inner), 256), 1, 16)))


def is_personal(name: str, fields: list[str] | None = None, patterns: list[str] | None = None) -> bool:
    """Whether a field name is personal, in whatever case."""
    import re

    lower = name.lower()
    return lower in (FIELDS if fields is None else fields) or any(re.match(p, lower) for p in (PATTERNS if patterns is None else patterns))


def mask_value(name: str, c: Column, key: bytes | None = None, salt: str = "") -> Column:
    """The mask (or, with a key, the token) of a field's value; null stays null."""
    text, lower = c.cast("string"), name.lower()
    if key is not None:
        out = token(text, key, salt)
    else:
        mask = next((m for part, m in (("email", mask_email), ("phone", mask_phone), ("name", mask_name), ("address", mask_address), ("street", mask_address)) if part in lower), mask_generic)
        out = mask(text)
    return F.when(text.isNotNull(), out)


def mask_struct(schema: T.StructType, get: Column | None = None, key: bytes | None = None, exempt: set[str] = frozenset()) -> list[Column]:
    """Columns of a struct with its personal fields masked, at any depth.

    A struct with a personal name is entered, not masked; of arrays, only structs in them are entered; fields named in
    `exempt` are left as they are, with all in them.
    """
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if get is None else get[f.name]
        if f.name in exempt:
            masked = c
        elif isinstance(f.dataType, T.StructType):
            masked = F.when(c.isNotNull(), F.struct(*mask_struct(f.dataType, c, key, exempt)))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            masked = F.transform(c, _entered(f.dataType.elementType, key, exempt))
        elif isinstance(f.dataType, T.ArrayType):
            masked = c
        elif is_personal(f.name):
            masked = mask_value(f.name, c, key)
        else:
            masked = c
        out.append(masked.alias(f.name))
    return out


def _entered(element: T.StructType, key: bytes | None, exempt: set[str]):
    return lambda x: F.struct(*mask_struct(element, x, key, exempt))


def mask_payload(payload: Column, key: bytes | None = None, salt: str = "", remove: set[str] = frozenset(), exempt: set[str] = frozenset()) -> Column:
    """A JSON payload of unknown shape with its personal fields masked: one Arrow-batched function over the texts.

    Texts that are no JSON objects come out as they are. Keys in `remove` are dropped.
    """
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _mask_text(t, key, salt, remove, exempt))

    return run(payload)


def _mask_text(text, key, salt, remove, exempt):
    import hashlib
    import hmac
    import json

    def one(name, v):
        s = str(v)
        lower = name.lower()
        if key is not None:
            return "tok_" + hmac.new(key, f"{salt}:{s}".encode(), hashlib.sha256).hexdigest()[:16] if s else ""
        stars = lambda w, short: w[0] + "*" * (len(w) - 1) if len(w) > 1 else short
        if "email" in lower:
            local, at, domain = s.rpartition("@")
            return f"{local[:1]}***@" + ".".join(stars(x, "*") for x in domain.split(".")) if at else "***@***.***"
        if "phone" in lower:
            digits = "".join(c for c in s if c.isdecimal())
            return "***-***-" + digits[-4:] if len(digits) >= 4 else "***-***-****"
        if "name" in lower:
            return " ".join(stars(w, w) for w in s.split()) if s else "***"
        if "address" in lower or "street" in lower:
            return " ".join(stars(w, "*") for w in s.split()[:3]) + " ***" if s else "*** **** ***"
        return "***" if not s else "*" * len(s) if len(s) <= 3 else s[0] + "*" * (len(s) - 2) + s[-1]

    def walk(o):
        out = {}
        for k, v in o.items():
            if k in remove:
                continue
            if k in exempt:
                out[k] = v
            elif isinstance(v, dict):
                out[k] = walk(v)
            elif isinstance(v, list):
                out[k] = [walk(x) if isinstance(x, dict) else x for x in v]
            else:
                out[k] = one(k, v) if v is not None and is_personal(k) else v
        return out

    if text is None:
        return None
    try:
        o = json.loads(text)
    except ValueError:
        return text
    return json.dumps(walk(o), ensure_ascii=False) if isinstance(o, dict) else text
