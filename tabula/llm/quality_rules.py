"""Quality rules with thresholds learned per language and source.

Every document gets counts from its whole text. Documents under fixed minimum rules fail
at once. For the others, five ratios are summarised by mergeable quantile sketches (KLL)
per (language, source): tasks sketch their own rows and the sketches are merged, so a
source with a third of all rows is no hot spot. A document is kept if each of its ratios
lies within the fences of its group, which are learned: a quantile of the group's own tail, and
beyond it ``reach`` times the distance of that quantile from the group's median, or ``margin``
where the group hardly varies (most documents have no symbols or repeated lines at all, and
no cutoff should follow from that alone). There is no cutoff that all groups share. Groups with
fewer than ``MIN_DOCS`` documents use the merged sketches of their language, and, if those are too
few as well, of all documents.

Null texts have no words and fail. A null language or source is a group like any other.
Rows are judged one by one, so repeated ids give repeated rows. Sketches of up to ``SKETCH_K``
documents are exact; larger ones are random within the sketch's error, so they are written
once to the shared folder and every reader sees the same thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import saved, small_side, workspace

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
SKETCH_K = 4096
MIN_DOCS = 200
#: Ratio -> (quantile of the tail, reach, margin, whether there is a lower fence as well, at 1 - quantile).
#: Documents full of symbols come in such numbers that the far tail is theirs, so that quantile lies before it.
FENCES = {
    "symbol_ratio": (0.75, 6.0, 0.03, False),
    "dup_line_ratio": (0.95, 6.0, 0.25, False),
    "repeat_ratio": (0.95, 6.0, 0.05, False),
    "mark_ratio": (0.95, 6.0, 0.05, False),
    "mean_word": (0.75, 10.0, 0.5, True),
}


def counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> DataFrame:
    """Per row: its id, language and source, and the counts of its text."""
    rows = df.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id", "lang", "source",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[!?]")).cast("long").alias("n_marks"),
        lines.alias("lines"),
    )
    rows = rows.withColumn("bits", F.length(F.bin(F.size("words").cast("long"))))
    # windows of three words: hash in the high bits, position in the low ones, sorted; equal
    # windows are then neighbours, and their words decide, not the hash
    window = "xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))"
    packed = f"coalesce(shiftleft(shiftright({window}, bits), bits) | cast(i as bigint), 0L)"
    rows = rows.withColumn(
        "windows", F.expr(f"sort_array(transform(if(size(words) < 3, array(), sequence(0, size(words) - 3)), i -> {packed}))")
    )
    place = lambda x: f"cast({x} & (shiftleft(1L, bits) - 1) as int)"
    same = lambda y: (
        f"coalesce(shiftright(x, bits) = shiftright({y}, bits) and "
        + " and ".join(f"get(words, {place('x')} + {j}) = get(words, {place(y)} + {j})" for j in range(3))
        + ", false)"
    )
    found = f"filter(windows, (x, i) -> {same('get(windows, i - 1)')} or {same('get(windows, i + 1)')})"
    rows = rows.withColumn("places", F.expr(f"sort_array(transform({found}, x -> coalesce({place('x')}, 0)))"))
    covered = (
        "aggregate(transform(places, (x, i) -> least(3, coalesce(get(places, i + 1) - x, 3))), 0L, (a, x) -> a + x)"
    )
    return rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        "n_symbols", "n_marks",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).alias("n_repeat_words"),
    )


def ratios() -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    return {
        "symbol_ratio": share("n_symbols", "word_chars"), "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "repeat_ratio": share("n_repeat_words", "n_words"), "mark_ratio": share("n_marks", "n_words"),
        "mean_word": share("word_chars", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def sketches(counted: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Quantile sketches (lang, source, n_docs, one column per ratio) of the rows not failed.
    Sketches of several tables are merged by ``merged``."""
    rows = counted.where(~base_failed()).select("lang", "source", *[c.alias(n) for n, c in ratios().items()])
    return rows.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.kll_sketch_agg_double(n, F.lit(k)).alias(n) for n in FENCES]
    )


def merged(sketched: DataFrame, *by: str, k: int = SKETCH_K) -> DataFrame:
    """Sketches merged over all columns but ``by``."""
    return sketched.groupBy(*by).agg(
        F.sum("n_docs").alias("n_docs"), *[F.kll_merge_agg_double(n, F.lit(k)).alias(n) for n in FENCES]
    )


def thresholds(sketched: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Fences (lang, source, low_<ratio>, high_<ratio>) of every group, from its own sketches or wider ones."""
    own, lang = sketched.alias("own"), merged(sketched, "lang").alias("wide")
    whole = merged(sketched).alias("whole")
    # one row per group on either side; the whole's sketches are one row
    rows = own.join(lang, F.col("own.lang").eqNullSafe(F.col("wide.lang"))).crossJoin(F.broadcast(whole))
    out = [F.col("own.lang").alias("lang"), F.col("own.source").alias("source")]
    for name, (tail, reach, margin, both) in FENCES.items():
        sketch = (
            F.when(F.col("own.n_docs") >= min_docs, F.col(f"own.{name}"))
            .when(F.col("wide.n_docs") >= min_docs, F.col(f"wide.{name}"))
            .otherwise(F.col(f"whole.{name}"))
        )
        at = lambda q: F.kll_sketch_get_quantile_double(sketch, F.lit(q))  # noqa: B023, E731
        above = at(tail) + F.greatest(reach * (at(tail) - at(0.5)), F.lit(margin))
        below = at(1 - tail) - F.greatest(reach * (at(0.5) - at(1 - tail)), F.lit(margin))
        out.append((below if both else F.lit(float("-inf"))).alias(f"low_{name}"))
        out.append(above.alias(f"high_{name}"))
    return rows.select(*out)


def judge(counted: DataFrame, fences: DataFrame) -> DataFrame:
    """``counted`` plus base_failed and kept."""
    f = small_side(fences, 300).alias("f")
    c = counted.alias("c")
    inside = F.lit(True)
    for name, value in ratios().items():
        inside = inside & value.between(F.col(f"f.low_{name}"), F.col(f"f.high_{name}"))
    joined = c.join(f, F.col("c.lang").eqNullSafe(F.col("f.lang")) & F.col("c.source").eqNullSafe(F.col("f.source")), "left")
    failed = base_failed()
    return joined.select("c.*", failed.alias("base_failed"), (~failed & F.coalesce(inside, F.lit(True))).alias("kept"))


def apply_rules(df: DataFrame, **columns: str) -> DataFrame:
    """Count, sketch, and judge every row of ``df``. Counts and sketches are written once to the shared folder."""
    spark = df.sparkSession
    path = workspace(spark, "quality-rules")
    counted = saved(counts(df, **columns), f"{path}/counts")
    sketched = saved(sketches(counted), f"{path}/sketches")
    fences = saved(thresholds(sketched), f"{path}/fences")
    return judge(counted, fences)
