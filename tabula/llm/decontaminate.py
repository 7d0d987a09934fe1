"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words. A fingerprint is the hash of ``K`` words;
of every ``W`` = ``SPAN`` - ``K`` + 1 consecutive fingerprints the smallest is kept, so every
run of ``SPAN`` words keeps the same fingerprints wherever it stands, and two texts that
share such a run share one. Kept fingerprints of documents are joined with those of the
benchmark, and each hit is extended word by word to both sides; runs of ``SPAN`` equal words
or more are leaked, and all their words are hit. An item with fewer words is one window: it
gets fingerprints of its own length class, and is leaked where all its words occur in a row.

Documents are taken in overlapping blocks of ``BLOCK_WORDS`` words, so a text of any length
costs linear work, and only document ids and hit ranges are shuffled. The benchmark side is
broadcast after its size is counted; a larger one is joined by a shuffle on the fingerprint,
which moves the blocks' words that the extension needs.

A null or empty text has no words. Rows that share an id (null is an id as well) are counted
as one document: their words add up, and equal ranges of hit words count once. Repeated
benchmark rows count once, items with a null id not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import ascii_lower, id_text, small_table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing, for counting them.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPAN = 10
K = 4
BLOCK_WORDS = 96
#: Counted bytes of a benchmark fingerprint row with its neighbours, and of each item that shares it, for the broadcast check.
ROW_BYTES, ITEM_BYTES = 400, 64


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _grams(k: int) -> str:
    """SQL: hash of every ``k`` consecutive words; null positions never occur below the bound."""
    own = ", ".join(f"get(words, i + {j})" for j in range(k))
    return f"transform(if(size(words) < {k}, array(), sequence(0, size(words) - {k})), i -> xxhash64({own}))"


def _kept(span: int, k: int, grams: str = "grams") -> str:
    """SQL: the distinct minima of every ``span - k + 1`` consecutive hashes."""
    w = span - k + 1
    least = f"get({grams}, i)" if w == 1 else "least(" + ", ".join(f"get({grams}, i + {j})" for j in range(w)) + ")"
    return (
        f"array_distinct(transform(if(size({grams}) < {w}, array(), sequence(0, size({grams}) - {w})), i -> {least}))"
    )


def _sides(span: int, k: int) -> tuple[str, str, str]:
    """SQL: the words before position ``p`` (nearest first), at it, and behind it, as far as a run can need."""
    w = span - k
    part = lambda a: "array(" + ", ".join(f"get(words, p + {j})" for j in a) + ")"
    none = "cast(array() as array<string>)"
    return part(range(-1, -w - 1, -1)) if w else none, part(range(k)), part(range(k, k + w)) if w else none


def _run(mine: str, theirs: str) -> str:
    """SQL: how many words from the first are equal."""
    same = f"transform({mine}, (x, j) -> coalesce(x = get({theirs}, j), false))"
    return f"if(array_position({same}, false) = 0, size({mine}), cast(array_position({same}, false) as int) - 1)"


def fingerprints(items: DataFrame, span: int, k: int, whole: bool) -> DataFrame:
    """Kept fingerprints of items (id, words) with their neighbours, equal ones with all their items.
    ``whole``: the items are those of exactly ``span`` words, else those of ``span`` or more."""
    own = items.where(F.size("words") == span if whole else F.size("words") >= span)
    before, at, behind = _sides(span, k)
    places = own.withColumn("grams", F.expr(_grams(k))).withColumn("kept", F.expr(_kept(span, k)))
    places = places.select("id", "words", "grams", F.explode_outer("kept").alias("fp")).select(
        "id", "words", "fp", F.explode_outer(F.expr(_PLACES)).alias("p")
    ).where("p is not null")
    return (
        places.select("id", "fp", F.expr(before).alias("i_before"), F.expr(at).alias("i_at"), F.expr(behind).alias("i_behind"))
        .groupBy("fp", "i_before", "i_at", "i_behind")
        .agg(F.collect_set("id").alias("items"))
    )


#: SQL: the positions of a fingerprint. Arrays are exploded with explode_outer: for the plain
#: form the optimizer adds a filter on the array's size, and computes the array twice.
_PLACES = "filter(sequence(0, greatest(size(grams) - 1, 0)), i -> get(grams, i) = fp)"


def _blocks(docs: DataFrame, span: int, stride: int) -> DataFrame:
    """Blocks (id, base, words) of the documents; every ``span`` words in a row lie in one."""
    cut = (
        f"transform(sequence(0, greatest(cast(ceil((size(words) - {span - 1}) / {stride}) as int) - 1, 0)), "
        f"b -> struct(b * {stride} as base, slice(words, b * {stride} + 1, {stride + span - 1}) as words))"
    )
    return docs.select("id", F.explode_outer(F.expr(cut)).alias("b")).select("id", "b.base", "b.words")


def leaks(docs: DataFrame, items: DataFrame, span: int, k: int, whole: bool, stride: int) -> DataFrame:
    """(id, start, end, items): leaked ranges of document words, end exclusive."""
    side = fingerprints(items, span, k, whole)
    kept = _blocks(docs, span, stride).withColumn("grams", F.expr(_grams(k))).select(
        "id", "base", "words", F.explode_outer(F.expr(_kept(span, k))).alias("fp")
    )
    hits = kept.join(small_table(side, ROW_BYTES + ITEM_BYTES * F.size("items").cast("long")), "fp").withColumn("grams", F.expr(_grams(k)))
    hits = hits.withColumn("p", F.explode_outer(F.expr(_PLACES))).drop("grams")
    before, at, behind = _sides(span, k)
    return (
        hits.where(F.expr(f"{at} = i_at"))
        .withColumn("l", F.expr(_run(before, "i_before")))
        .withColumn("r", F.expr(_run(behind, "i_behind")))
        .where(F.col("l") + F.col("r") + k >= span)
        .select("id", (F.col("base") + F.col("p") - F.col("l")).alias("start"),
                (F.col("base") + F.col("p") + k + F.col("r")).alias("end"), "items")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", span: int = SPAN, k: int = K,
                  stride: int = BLOCK_WORDS) -> DataFrame:
    """Per document id: n_words, n_hit, item_ids (those with leaked windows, as sorted strings), contaminated."""
    texts = id_text(docs, id_col, text_col)
    own = texts.select("id", words_of(F.col("text")).alias("words"))
    items = id_text(benchmark, item_col, item_text).select(
        F.col("id").cast("string").alias("id"), words_of(F.col("text")).alias("words")
    ).where("id is not null").distinct()
    sizes = items.agg(
        F.max(F.size("words") >= span).alias("long"),
        F.sort_array(F.collect_set(F.when(F.size("words") < span, F.size("words")))).alias("short"),
    ).first()
    found = [leaks(own, items, span, k, False, stride)] if sizes.long else []
    found += [leaks(own, items, n, min(k, n), True, stride) for n in sizes.short if n > 0]
    base = texts.groupBy("id").agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(ANY_WORD)), F.lit(0))).alias("n_words"))
    if not found:
        none = F.array().cast("array<string>")
        return base.select(F.col("id").alias(id_col), "n_words", F.lit(0).cast("long").alias("n_hit"),
                           none.alias("item_ids"), F.lit(False).alias("contaminated"))
    ranges = found[0]
    for more in found[1:]:
        ranges = ranges.unionByName(more)
    # equal ranges of one document become one before the shuffle; what is left is bounded by its own words
    spans = ranges.groupBy("id").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("item_ids"),
    )
    covered = F.expr(
        "aggregate(spans, struct(0L as n, 0 as upto), "
        "(a, s) -> struct(a.n + greatest(s.end - greatest(s.start, a.upto), 0) as n, greatest(a.upto, s.end) as upto), a -> a.n)"
    )
    hit = spans.select(F.col("id").alias("hit_id"), covered.alias("n_hit"), "item_ids")
    return base.join(hit, base["id"].eqNullSafe(hit["hit_id"]), "left").select(
        base["id"].alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The counts of ``decontaminate`` with the items as a number and a digest."""
    found = decontaminate(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )
