"""Canonical text, digests and identifier formats."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Identifier formats, matched over the whole text.
PATTERNS: dict[str, str] = {
    "batch_id": "[A-Za-z0-9][A-Za-z0-9._-]{0,127}",
    "manifest_digest": "[a-f0-9]{64}",
    "generation_id": "g-[A-Za-z0-9_-]+-[a-f0-9]{12}",
    "database": "[A-Za-z_][A-Za-z0-9_]*",
}


def contract_regex(value: Column, name: str) -> Column:
    """Full match: \\z, unlike $, does not let a trailing newline through."""
    return value.rlike(rf"\A(?:{PATTERNS[name]})\z")


def _ordered(value: Column, kind: T.DataType) -> Column:
    """The same value with struct fields in name order at every level."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda field: field.name)
        ordered = F.struct(
            *[_ordered(value[field.name], field.dataType).alias(field.name) for field in fields]
        )
        return F.when(value.isNotNull(), ordered)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return F.transform(value, lambda item: _ordered(item, kind.elementType))
    return value


def _lowered_escapes(text: Column) -> Column:
    """Spark's escapes in lower case, and DEL escaped too.

    A doubled backslash is set aside first (JSON never holds a raw control character), so that only
    real escapes are rewritten.
    """
    aside = F.replace(text, F.lit("\\\\"), F.lit("\x01"))
    pieces = F.split(aside, r"\\u")
    lowered = F.transform(
        pieces,
        lambda piece, index: F.when(index == 0, piece).otherwise(
            F.concat(F.lower(F.substring(piece, 1, 4)), piece.substr(F.lit(5), F.length(piece)))
        ),
    )
    joined = F.array_join(lowered, "\\u")
    return F.replace(
        F.replace(joined, F.lit("\x7f"), F.lit("\\u007f")), F.lit("\x01"), F.lit("\\\\")
    )


#: Text that JSON shows as it is: printable ASCII but for the quote and the backslash.
_PLAIN = r"[ !#-\[\]-~]*"
#: Types whose JSON form is their cast to text.
_SHOWN_AS_CAST = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType())


def _member(name: str, kind: T.DataType) -> Column:
    """`"name":value` of a column that needs no escapes."""
    key, value = f'"{name}":', F.col(name)
    if kind in _SHOWN_AS_CAST:
        return F.concat(F.lit(key), F.coalesce(value.cast("string"), F.lit("null")))
    return F.when(value.isNull(), F.lit(f"{key}null")).otherwise(F.concat(F.lit(f'{key}"'), value, F.lit('"')))


def ordered_json(
    frame: DataFrame, columns: Sequence[str] | None = None, *, escape: bool = True
) -> Column:
    """One JSON object per row: keys sorted, no spaces, nulls kept; non-ASCII escaped on demand.

    Rows of whole numbers, truth values and short plain texts, as in the retail tables, are concatenated, which
    takes a fraction of the time; a row with any text to escape goes to the encoder whole.
    """
    wanted = sorted(columns or frame.columns)
    kinds = {field.name: field.dataType for field in frame.schema.fields}
    row = F.struct(*[_ordered(F.col(name), kinds[name]).alias(name) for name in wanted])
    options = {"ignoreNullFields": "false"}
    if escape:
        options["writeNonAsciiCharacterAsCodePoint"] = "true"
    encoded = F.to_json(row, options)
    texts = [F.col(name) for name in wanted if kinds[name] == T.StringType()]
    simple = all(kinds[name] in (*_SHOWN_AS_CAST, T.StringType()) for name in wanted)
    if not (escape and wanted and simple and all(re.fullmatch(_PLAIN, name) for name in wanted)):
        return encoded
    members = [_member(name, kinds[name]) for name in wanted]
    commas = [F.lit(",")] * len(members)
    joined = [part for pair in zip(commas, members) for part in pair][1:]
    plain = F.concat(F.lit("{"), *joined, F.lit("}"))
    if not texts:
        return plain
    return F.when(F.concat_ws("", *texts).rlike(rf"\A{_PLAIN}\z"), plain).otherwise(encoded)


def holds_text(frame: DataFrame, columns: Sequence[str]) -> bool:
    """Whether canonical JSON of the columns may hold escapes; numbers and truth values under plain names do not."""
    kinds = {field.name: field.dataType for field in frame.schema.fields}
    return any(kinds[name] not in _SHOWN_AS_CAST or not re.fullmatch(_PLAIN, name) for name in columns)


def canonical_escapes(text: Column) -> Column:
    """The escapes of `ordered_json` in their canonical form; most rows hold none and pass as is."""
    holds_any = text.contains("\\u") | text.contains("\x7f")
    return F.when(holds_any, _lowered_escapes(text)).otherwise(text)


def canonical_row_json(
    frame: DataFrame, columns: Sequence[str] | None = None, *, escape: bool = True
) -> Column:
    """Canonical JSON of each row: sorted keys, no spaces, nulls kept, ASCII unless escape is off."""
    encoded = ordered_json(frame, columns, escape=escape)
    return canonical_escapes(encoded) if escape and holds_text(frame, columns or frame.columns) else encoded


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def generation_id(batch_id: Column, manifest_digest: Column) -> Column:
    """g-<safe batch, at most 64 characters>-<first 12 hex digits of sha256(batch:digest)>."""
    dashed = F.regexp_replace(batch_id, "[^A-Za-z0-9_-]", "-")
    trimmed = F.btrim(dashed, F.lit("-")).substr(1, 64)
    safe = F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("batch"))
    identity = F.sha2(F.concat_ws(":", batch_id, manifest_digest), 256).substr(1, 12)
    return F.concat(F.lit("g-"), safe, F.lit("-"), identity)


def entity_key(*parts: Column) -> Column:
    """Display form of a composite id. Group and join on the columns: joined text can collide."""
    return F.concat_ws(":", *[part.cast("string") for part in parts])


def uri_parts(uri: Column, schemes: Sequence[str] = ("s3",)) -> Column:
    """struct(scheme, bucket, key); null unless scheme is allowed and bucket and path are present."""
    pattern = rf"\A({'|'.join(schemes)})://([^/?#]+)(/[^?#]*)"
    parts = F.struct(
        F.regexp_extract(uri, pattern, 1).alias("scheme"),
        F.regexp_extract(uri, pattern, 2).alias("bucket"),
        F.ltrim(F.regexp_extract(uri, pattern, 3), F.lit("/")).alias("key"),
    )
    return F.when(uri.rlike(pattern), parts)


def checksum_hex(base64_checksum: Column) -> Column:
    return F.lower(F.hex(F.unbase64(base64_checksum)))


def etag_normalize(etag: Column) -> Column:
    return F.btrim(etag, F.lit('"'))


def failure_stage(text: Column) -> Column:
    return text.substr(1, 64)


def failure_code(text: Column) -> Column:
    return text.substr(1, 512)


def run_prefix(name: Column) -> Column:
    """Text before the first dash, the whole text when there is none."""
    return F.split_part(name, F.lit("-"), F.lit(1))


def manifest_digest(document: dict) -> str:
    """sha256 of one canonical manifest document, leaving out the digest it carries itself."""
    identity = {name: value for name, value in document.items() if name != "identity_digest"}
    encoded = json.dumps(identity, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(encoded.encode("utf-8")).hexdigest()
