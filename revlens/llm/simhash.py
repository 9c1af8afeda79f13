"""SimHash fingerprints of whole texts, in DataFrame functions only.

Terms are runs of two lower-cased words, weighted by how often they occur.
Each term's 128 hash bits vote; a fingerprint bit is set where the set votes
are more than half.  Votes are counted in four 16-bit lanes of a long, so 32
ordinary sums over the exploded terms count all 128 bits; texts of more terms
than a lane holds are summed in stretches whose lanes are then widened.

``near_pairs`` finds all pairs of fingerprints within a Hamming radius:
fingerprints are cut into blocks, and for every choice of blocks that a pair
within the radius must share a permuted table is keyed by them.

Defined cases: a null text counts as empty; without words all bits are 0;
equal texts have equal fingerprints; rows of equal id follow each other in
the order of their texts' hashes; an empty table gives no rows; a table of
one row is its own next document.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 128
#: Terms of one stretch: what a 16-bit lane can count without its sign bit.
STRETCH = 32_000
#: Documents in one run of neighbouring ids.
RUN_ROWS = 5_000

_LANES = 0x0001_0001_0001_0001
_SPREAD = 1 + (1 << 15) + (1 << 30) + (1 << 45)
_WIDE = 0x0000_FFFF_0000_FFFF


def _with_terms(df: DataFrame, text: str) -> DataFrame:
    """Replace ``text`` by ``terms``: hashes of its runs of two words, in
    order (the last word is a run by itself)."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    others = [c for c in df.columns if c != text]
    after = F.slice("__words", 2, F.greatest(F.size("__words") - 1, F.lit(1)))
    return (df.select(*others, F.transform(words, lambda w: F.xxhash64(w)).alias("__words"))
            .select(*others, F.zip_with("__words", after, lambda a, b: F.xxhash64(a, b)).alias("terms")))


def _votes() -> list[Column]:
    """Four bits of the term's hashes in four lanes, for every four of 128 bits."""
    out = []
    for half in ("term", "term2"):
        for k in range(0, 64, 4):
            bits = F.shiftrightunsigned(F.col(half), k).bitwiseAND(F.lit(15))
            out.append((bits * F.lit(_SPREAD)).bitwiseAND(F.lit(_LANES)))
    return out


def _bit(count: Column, n: Column) -> Column:
    return F.when(count * 2 > n, F.lit("1")).otherwise(F.lit("0"))


def fingerprints(df: DataFrame, keys: list[str], texts: dict[str, Column]) -> DataFrame:
    """One row per row of ``df``: its ``keys`` and, for every entry of
    ``texts``, the fingerprint of that text as 32 hex digits.

    ``keys`` must tell rows apart.  If ``df`` is already dealt by them the
    sums need no shuffle.
    """
    which = F.array(*(F.struct(F.lit(i).alias("i"), F.coalesce(t, F.lit("")).alias("t")) for i, t in enumerate(texts.values())))
    each = (_with_terms(df.select(*keys, F.explode(which).alias("of")).select(
                *keys, F.col("of.i").alias("__i"), F.col("of.t").alias("__text")), "__text")
            .select(*keys, "__i", F.posexplode_outer("terms").alias("__at", "term"))
            .withColumn("term2", F.when(F.col("term").isNotNull(), F.xxhash64("term", F.lit(1)))))
    lanes = [f"v{j}" for j in range(BITS // 4)]
    narrow = (each.select(*keys, "__i", F.floor(F.coalesce("__at", F.lit(0)) / STRETCH).alias("__stretch"), "term",
                          *(v.alias(c) for v, c in zip(_votes(), lanes)))
              .groupBy(*keys, "__i", "__stretch")
              .agg(F.count("term").alias("n"), *(F.sum(c).alias(c) for c in lanes)))
    wide = []
    for c in lanes:
        wide += [F.sum(F.col(c).bitwiseAND(F.lit(_WIDE))).alias(f"{c}_even"),
                 F.sum(F.shiftrightunsigned(F.col(c), 16).bitwiseAND(F.lit(_WIDE))).alias(f"{c}_odd")]
    total = narrow.groupBy(*keys, "__i").agg(F.sum("n").alias("n"), *wide)
    low = F.lit(0xFFFF_FFFF)
    n = F.col("n")
    # Bits 3..0 of a hex digit: odd and even lanes, upper and lower halves.
    digit = [F.conv(F.concat(
        _bit(F.shiftrightunsigned(F.col(f"{c}_odd"), 32), n), _bit(F.shiftrightunsigned(F.col(f"{c}_even"), 32), n),
        _bit(F.col(f"{c}_odd").bitwiseAND(low), n), _bit(F.col(f"{c}_even").bitwiseAND(low), n)), 2, 16) for c in lanes]
    hexed = total.select(*keys, "__i", F.lower(F.concat(*digit)).alias("__hex"))
    return hexed.groupBy(*keys).agg(*(
        F.max(F.when(F.col("__i") == i, F.col("__hex"))).alias(name) for i, name in enumerate(texts)))


def _halves(hexed: Column) -> list[Column]:
    """A fingerprint as four longs of 32 bits."""
    return [F.conv(F.substring(hexed, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def distance(a: Column, b: Column) -> Column:
    """Hamming distance of two fingerprints."""
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(_halves(a), _halves(b))), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, 0 for opposite ones."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def near_pairs(df: DataFrame, radius: int, fingerprint: str = "fingerprint", blocks: int | None = None) -> DataFrame:
    """All pairs (a, b, distance), a < b, of distinct fingerprints at most ``radius`` bits apart.

    Of ``blocks`` blocks a pair differs in at most ``radius``, so it agrees
    on all of some choice of the others: one permuted table per choice.
    Fingerprints that many documents have are one row here.
    """
    blocks = blocks or radius + 2
    digits = BITS // 4
    edges = [round(i * digits / blocks) for i in range(blocks + 1)]
    own = df.select(F.col(fingerprint).alias("a")).where("a is not null").distinct()
    tables = [F.struct(F.lit(n).alias("table"), F.concat(*(
        F.substring("a", edges[i] + 1, edges[i + 1] - edges[i]) for i in same)).alias("key"))
        for n, same in enumerate(combinations(range(blocks), blocks - radius))]
    keyed = own.select("a", F.explode(F.array(*tables)).alias("k")).select("a", "k.table", "k.key")
    met = keyed.join(keyed.withColumnRenamed("a", "b"), ["table", "key"]).where("a < b").select("a", "b").distinct()
    return met.withColumn("distance", distance(F.col("a"), F.col("b"))).where(F.col("distance") <= radius)


def _run_of(doc_id: Column, starts: list[int]) -> Column:
    """Number of starts at or below ``doc_id``, by binary search."""
    edges = F.array(*(F.lit(s) for s in starts)) if starts else F.array().cast("array<long>")
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, len(starts).bit_length())))))
    return F.aggregate(steps, F.lit(0), lambda lo, step: F.when(
        F.get(edges, lo + step - F.lit(1)) <= doc_id, lo + step).otherwise(lo))


def edited_neighbours(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with the next one's text, in runs of neighbouring ids.

    Runs start at approximate quantiles of the ids.  The first document of a
    run is sent along to the run before it, so each run finds all its next
    documents; the last run gets the first document of all.  Columns: run and
    place (together they tell rows apart), sent (of such a copy), doc_id,
    text, next_text.
    """
    docs = df.select(df[doc_id].cast("long").alias("doc_id"), F.coalesce(df[text], F.lit("")).alias("text"))
    n = docs.count()
    runs = max(1, -(-n // RUN_ROWS))
    share = [k / runs for k in range(1, runs)]
    found = docs.agg(F.percentile_approx("doc_id", share or [0.5], 10 * runs + 100).alias("q"), F.min("doc_id").alias("least")).first()
    least = found["least"]
    starts = sorted(set(found["q"] or []) - {least}) if share else []
    tie = F.xxhash64("text")
    run = F.coalesce(_run_of(F.col("doc_id"), starts), F.lit(0))
    first = F.array(*(F.lit(s) for s in [least, *starts])) if least is not None else F.array().cast("array<long>")
    last = len(starts)
    # Rows: the document in its own run, and a copy behind the run before if its id starts a run.
    homes = F.when(F.array_contains(first, F.col("doc_id")), F.array(
        F.struct(run.alias("run"), F.lit(False).alias("sent")),
        F.struct(F.when(run == 0, F.lit(last)).otherwise(run - 1).alias("run"), F.lit(True).alias("sent")))
    ).otherwise(F.array(F.struct(run.alias("run"), F.lit(False).alias("sent"))))
    order = Window.partitionBy("run").orderBy("sent", F.col("doc_id").asc_nulls_first(), "tie")
    return (docs.select("doc_id", "text", tie.alias("tie"), F.explode(homes).alias("home"))
            .select("doc_id", "text", "tie", "home.run", "home.sent")
            .withColumn("next_text", F.lead("text").over(order))
            .withColumn("place", F.row_number().over(order))
            .drop("tie"))


def edited(text: Column, after: Column) -> Column:
    """``text`` with its last half replaced by the beginning of ``after``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(after, F.lit(1), half))


def document_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    next_fingerprint, near_edited and near_next of every row."""
    new = edited(F.col("text"), F.coalesce("next_text", F.lit("")))
    placed = (edited_neighbours(df, doc_id, text).select("run", "place", "sent", "doc_id", "text", new.alias("edited"))
              .select("run", "place", "sent", "doc_id", "text", "edited",
                      F.char_length("text").cast("long").alias("n_chars"),
                      F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256")))
    keys = ["run", "place", "sent", "doc_id", "n_chars", "edited_sha256"]
    found = fingerprints(placed, keys, {"fingerprint": F.col("text"), "edited_fingerprint": F.col("edited")})
    after = F.lead("fingerprint").over(Window.partitionBy("run").orderBy("place"))
    return (found.withColumn("next_fingerprint", after).where("not sent")
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")))
