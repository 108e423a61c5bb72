"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a column expression over the text, so the verdict needs no shuffle and no user
function. Null text counts as empty. An empty text fails the length rule. Repeated rows and ties are
judged one by one, alike. An empty table gives an empty table. A text is judged whole, however long, from
arrays of its words that live in one row only. Columns of the input that are named like a measure or a
verdict are replaced by judge(); keep_good() returns the input's columns as they were. No other name clashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm.common import fresh, without, words

# Function words of the four languages of the corpus.
STOP_WORDS = tuple(
    "the be to of and that have with in is on for "
    "le la les de des et un une en que qui est du dans pour "
    "der die das und den zu von mit ist ein eine nicht auf für "
    "el los las y del que por con una para se no".split()
)

SYMBOLS = "[#*$%&|<>]"
ELLIPSIS = "…"


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= measure <= high; a missing bound holds nothing back."""

    measure: str
    low: float | None = None
    high: float | None = None


# The verdict beside the base rule: ratios are per word or per line. 0.1 symbols a word and 0.9 of the lines as bullets are
# bounds of published rules for web text (there of hashes and ellipses, here of SYMBOLS); the others are this module's own.
RULES = (
    Rule("n_words", low=50),
    Rule("mean_word_chars", low=2.0, high=14.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.01),
    Rule("dup_line_ratio", high=0.5),
    Rule("ellipsis_line_ratio", high=0.4),
    Rule("bullet_line_ratio", high=0.9),
)


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures. Each stage names arrays that the next one reads more than once."""
    body = F.coalesce(F.col(text), F.lit(""))
    w, ls, g, p, lines = fresh(df.columns, "_w", "_l", "_g", "_p", "_n_lines")
    df = df.withColumns({w: words(F.col(text)), ls: F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))})
    n = F.size(w)
    window = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn(g, F.when(n >= 3, F.array_sort(F.transform(F.sequence(F.lit(0), n - 3), window))).otherwise(none))
    same = lambda x, j, k: F.coalesce(F.get(g, j + k)["h"] == x["h"], F.lit(False))
    seen = F.filter(g, lambda x, j: same(x, j, 1) | same(x, j, -1))
    df = df.withColumn(p, F.array_sort(F.transform(seen, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform(p, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - at, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    n_lines = F.greatest(F.size(ls), F.lit(1))
    per_word = F.greatest(n, F.lit(1))
    stops = F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS)))
    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
            "n_repeat_words": covered,
            "stop_word_ratio": stops / per_word,
            "ellipsis_line_ratio": F.size(F.filter(ls, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith(ELLIPSIS))) / n_lines,
            "bullet_line_ratio": F.size(F.filter(ls, lambda x: F.ltrim(x).rlike("^[-*•‣▪]"))) / n_lines,
            lines: n_lines,
        }
    )
    return df.withColumns(
        {
            "mean_word_chars": F.col("word_chars") / F.greatest("n_words", F.lit(1)),
            "symbol_ratio": F.col("n_symbols") / F.greatest("n_words", F.lit(1)),
            "dup_line_ratio": F.col("n_dup_lines") / F.col(lines),
        }
    ).drop(w, ls, g, p, lines)


def verdict(rules=RULES) -> Column:
    """The table as one boolean expression."""
    passed = F.lit(True)
    for r in rules:
        if r.low is not None:
            passed &= F.col(r.measure) >= r.low
        if r.high is not None:
            passed &= F.col(r.measure) <= r.high
    return passed


#: What judge() adds.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stop_word_ratio", "ellipsis_line_ratio", "bullet_line_ratio", "mean_word_chars", "symbol_ratio", "dup_line_ratio")


def judge(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The input's columns, the measures, base_failed and kept.

    What is added passes through a generator of one row, below which no filter is pushed: pushed down, a
    verdict would take the arrays' expressions with it into lambdas that run once for each element.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    added = F.struct(*MEASURES, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
    own = without(df.columns, *MEASURES, "base_failed", "kept")
    return measures(df, text).select(*own, F.inline(F.array(added)))


def keep_good(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The input's rows that the rules keep."""
    judged = judge(df.select(F.col(text).alias("_text"), F.struct(*df.columns).alias("_row")), "_text", rules)
    return judged.where("kept").select("_row.*")


def op5(spark, sf_dir: str) -> DataFrame:
    from sitefold.llm.common import documents

    out = judge(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _rules_sql(rules=RULES) -> str:
    parts = []
    for r in rules:
        if r.low is not None:
            parts.append(f"{r.measure} >= {r.low}")
        if r.high is not None:
            parts.append(f"{r.measure} <= {r.high}")
    return " AND ".join(parts)


MEASURES_SQL = rf"""
w AS (SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\f\r]+'), lambda x: x <> '') ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) ls FROM {{docs}}),
g AS (SELECT *, [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)] gs FROM w),
d AS (SELECT *, list_transform(list_filter(map_entries(histogram_of), lambda e: e.value > 1), lambda e: e.key) rs
      FROM (SELECT *, coalesce((SELECT histogram(u) FROM (SELECT unnest(gs) u)), MAP {{{{}}}}) histogram_of FROM g)),
c AS (SELECT *, [i for i in range(1, len(gs) + 1) if list_contains(rs, gs[i])] ps FROM d),
m AS (SELECT * EXCLUDE (histogram_of, gs, rs),
        len(ws)::BIGINT n_words, length(array_to_string(ws, ''))::BIGINT word_chars,
        len(regexp_extract_all(coalesce(text, ''), '{SYMBOLS}'))::BIGINT n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT n_dup_lines,
        coalesce(list_sum([least(3, coalesce(ps[k + 1] - ps[k], 3)) for k in range(1, len(ps) + 1)]), 0)::BIGINT n_repeat_words,
        greatest(len(ws), 1) pw, greatest(len(ls), 1) pl FROM c),
q AS (SELECT *, len(list_filter(ws, lambda x: lower(x) IN ({_in(STOP_WORDS)}))) / pw stop_word_ratio,
        len(list_filter(ls, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%{ELLIPSIS}')) / pl ellipsis_line_ratio,
        len(list_filter(ls, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•‣▪]'))) / pl bullet_line_ratio,
        word_chars / pw mean_word_chars, n_symbols / pw symbol_ratio, n_dup_lines / pl dup_line_ratio,
        (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) base_failed FROM m)
"""

SQL = f"""WITH {MEASURES_SQL.format(docs="documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {_rules_sql()}) kept FROM q"""
