"""Ids, types, routing subjects and payload limits of change events, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The event type of each operation.
EVENT_TYPES = {"INSERT": "cdc.insert", "UPDATE": "cdc.update", "DELETE": "cdc.delete", "DDL": "cdc.ddl"}
#: Fixed value: bytes of payload that a dead-letter record keeps.
PREFIX_BYTES = 65536


def event_type(op: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in EVENT_TYPES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, op), F.lit("cdc.unknown"))


def event_id(lsn: Column, txid: Column, op: Column, schema: Column, table: Column, seq: Column) -> Column:
    """lsn:txid:op:schema.table:seq, the same at every replay; row values have no part in it."""
    return F.concat_ws(":", lsn, txid.cast("string"), op, F.concat(schema, F.lit("."), table), seq.cast("string"))


def subject(database: Column | str, schema: Column, table: Column) -> Column:
    """cdc.database.schema.table, as it is."""
    database = F.lit(database) if isinstance(database, str) else database
    return F.concat(F.lit("cdc."), database, F.lit("."), schema, F.lit("."), table)


def token(text: Column) -> Column:
    """A subject token: trimmed, blanks and wildcards replaced by _, _ if empty; dots stay."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t == "", F.lit("_")).otherwise(F.translate(t, " *>", "___"))


def dead_letter_subject(prefix: Column, database: Column, schema: Column, table: Column) -> Column:
    return F.concat_ws(".", token(prefix), token(database), token(schema), token(table))


def payload_prefix(payload: Column, limit: int = PREFIX_BYTES) -> list[Column]:
    """payload_size in bytes, truncated, and payload_prefix of at most limit bytes (a character that is cut goes)."""
    raw = payload.cast("binary")
    size = F.octet_length(payload)
    # up to three bytes of a character may remain at the cut
    cut = F.coalesce(
        *[F.try_validate_utf8(F.substring(raw, 1, limit - i).cast("string")) for i in range(4)],
        F.lit(""),
    )
    return [
        size.alias("payload_size"),
        (size > limit).alias("truncated"),
        F.when(size > limit, cut).otherwise(payload).alias("payload_prefix"),
    ]


def csv_items(text: Column) -> Column:
    """A comma-separated list's trimmed items, empty ones dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def url_database(url: Column) -> Column:
    """The database name in a URL's path, empty without one."""
    return F.coalesce(F.trim(F.try_parse_url(url, F.lit("PATH")), F.lit("/")), F.lit(""))


def subject_regex(pattern: str) -> str:
    """A subject filter as a regular expression: * is one token, a final > is the rest (which may be none)."""
    out = ""
    for i, t in enumerate(tokens := pattern.split(".")):
        if t == ">" and i == len(tokens) - 1:
            return "^" + out + (r"(\.[^.]+)*$" if i else ".*$")
        piece = "[^.]+" if t == "*" else "".join("\\" + c if not c.isalnum() and c != "_" else c for c in t)
        out += (r"\." if i else "") + piece
    return "^" + out + "$"
