"""Cross-site line dedup by distinct-site spread.

A line's hash gets a HyperLogLog sketch of the sites (sources) that it occurs
on. The sketch is M registers of W bits in a few longs: bit r of a register
says that a site of rank r fell into it, the register's value is its highest bit,
and sketches merge with bit_or, so the partial sums are merged before the
shuffle and a line of a third of all documents is a few rows there. Lines whose
estimate lies clearly above the threshold are boilerplate; lines near it get an
exact count of distinct sites; the rest stays.

Of a boilerplate line the first occurrence (smallest doc_id, then line number)
stays and all others go, so no text is lost from the corpus; a document that
loses all its lines with a word is dropped by dedup_lines.

Lines are split at \\n. Lines with under MIN_CHARS characters that aren't white
space are left alone.

Defined cases: null text is kept as it is and has no lines; a null source is a
site of its own; null doc_ids rank last; documents that repeat an id with other
columns are separate rows; an empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

MIN_SITES = 10
MIN_CHARS = 12
#: Registers, bits of each, and registers in a long.
M, W = 32, 10
PER = 6
ALPHA = 0.697
#: Estimates within this factor of the threshold are counted exactly: over five standard errors of M registers.
NEAR = 1 + 5.5 * 1.04 / math.sqrt(M)
SPACES = " \t\n\x0b\x0c\r"


def _sketch(site: Column) -> list[Column]:
    """One site's sketch: longs of which one has one bit set."""
    h = F.xxhash64(site)
    register = F.pmod(h, F.lit(M))
    rest = F.shiftrightunsigned(h, 5).bitwiseOR(F.lit(1 << (W - 1)))
    # the lowest bit that is set, as its number: rest & -rest is a power of two
    rank = F.round(F.log2(rest.bitwiseAND(-rest).cast("double"))).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.pmod(register, F.lit(PER)) * W + rank).cast("int"))
    return [F.when(F.floor(register / PER) == i, bit).otherwise(F.lit(0).cast("long")) for i in range(-(-M // PER))]


def _estimate(longs: list[str]) -> Column:
    """The HyperLogLog estimate, by empty registers where it is small; sketches of one bit are one site's."""
    bits = sum((F.bit_count(F.col(n)) for n in longs), F.lit(0))

    def value(r: Column) -> Column:
        word = F.array(*longs)[F.floor(r / PER).cast("int")]
        field = F.call_function("shiftrightunsigned", word, ((r % PER) * W).cast("int")).bitwiseAND(F.lit((1 << W) - 1).cast("long"))
        return F.when(field == 0, 0).otherwise(F.floor(F.log2(field.cast("double") + 0.5)) + 1).cast("double")

    values = F.transform(F.sequence(F.lit(0), F.lit(M - 1)), value)
    sums = F.aggregate(
        values,
        F.struct(F.lit(0.0).alias("t"), F.lit(0).alias("e")),
        lambda a, v: F.struct((a["t"] + F.pow(F.lit(0.5), v)).alias("t"), (a["e"] + (v == 0).cast("int")).alias("e")),
        lambda a: F.when(
            (ALPHA * M * M / a["t"] <= 2.5 * M) & (a["e"] > 0), M * F.log(M / F.greatest(a["e"], F.lit(1)))
        ).otherwise(ALPHA * M * M / a["t"]),
    )
    return F.when(bits < 2, F.lit(1.0)).otherwise(sums)


def _key(line: Column) -> Column:
    return F.xxhash64(line, F.length(line))


def _lines(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep, pos and h of every line that may be boilerplate."""
    each = docs.where("text is not null").select(*keep, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return each.where(F.length(F.translate("line", SPACES, "")) >= MIN_CHARS).select(*keep, "pos", _key(F.col("line")).alias("h"))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """h, n_sites (an estimate where it is far above the threshold), exact, first_doc, first_pos of each boilerplate line."""
    site = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("")).alias("site")
    lines = _lines(docs.select("doc_id", "text", site), ["doc_id", "site"])
    longs = [f"r{i}" for i in range(-(-M // PER))]
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "pos")
    sketched = lines.select("h", place.alias("place"), *[c.alias(n) for n, c in zip(longs, _sketch(F.col("site")))])
    spread = sketched.groupBy("h").agg(*[F.bit_or(n).alias(n) for n in longs], F.min("place").alias("first"))
    spread = spread.select("h", "first", _estimate(longs).alias("n_sites"))
    wide = saved(spread.where(F.col("n_sites") >= min_sites / NEAR), "spread")
    near = wide.where(F.col("n_sites") < min_sites * NEAR)
    counted = lines.join(near.select("h"), "h").groupBy("h", "site").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("one").alias("exact"))
    # the near lines' counts, saved so that later joins start from files
    return saved(
        wide.join(counted, "h", "left")
        .where(F.coalesce(F.col("exact").cast("double"), F.col("n_sites")) >= min_sites)
        .select("h", F.coalesce(F.col("exact").cast("double"), F.col("n_sites")).alias("n_sites"), F.col("exact").isNotNull().alias("exact"), F.col("first.doc_id").alias("first_doc"), F.col("first.pos").alias("first_pos")),
        "boilerplate",
    )


def _removals(docs: DataFrame, min_sites: int) -> DataFrame:
    """doc_id and gone (line numbers that go) of each id that loses lines."""
    found = boilerplate(docs, min_sites)
    lines = _lines(docs, ["doc_id"])
    gone = lines.join(found, "h").where(~(F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("pos") == F.col("first_pos"))))
    return gone.groupBy("doc_id").agg(F.collect_set("pos").alias("gone"), F.collect_set("h").alias("gone_h"))


def _applied(docs: DataFrame, min_sites: int) -> DataFrame:
    """docs with _text, _n and _gone: the text left, its lines and how many went."""
    gone = _removals(docs.select("doc_id", "text", "source"), min_sites).select(F.col("doc_id").alias("_id"), "gone", "gone_h")
    d = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]), "left")
    lines = F.split(docs["text"], "\n")
    # rows that share an id: a line goes only where its own hash says so
    left = F.filter(
        lines, lambda x, i: ~(F.array_contains("gone", i) & F.array_contains("gone_h", _key(x)))
    )
    return d.withColumns(
        {
            "_n": F.when(docs["text"].isNotNull(), F.size(lines)).otherwise(F.lit(0)),
            "_kept": F.when(F.col("gone").isNotNull() & docs["text"].isNotNull(), left),
        }
    ).withColumns(
        {
            "_text": F.when(F.col("_kept").isNotNull(), F.array_join("_kept", "\n")).otherwise(docs["text"]),
            "_gone": F.when(F.col("_kept").isNotNull(), F.col("_n") - F.size("_kept")).otherwise(F.lit(0)),
        }
    )


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, a row for each row of docs."""
    return _applied(docs.select("doc_id", "text", "source"), min_sites).select(
        "doc_id", F.col("_n").cast("long").alias("n_lines"), F.col("_gone").cast("long").alias("n_removed"), F.col("_text").alias("text")
    )


def dedup_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """docs with the text that is left (n_chars follows it); documents that lost all their words go."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text", "source")
    out = _applied(row, min_sites).where((F.col("_gone") == 0) | (F.length(F.translate("_text", SPACES, "")) > 0))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_gone") > 0, F.length("_text").cast("long")).otherwise(F.col("_row")["n_chars"])
    return out.select(*[(new[c] if c in new else F.col("_row")[c]).alias(c) for c in docs.columns])
