"""Language-model scores from a subword lattice.

A word's probability under the lattice is the sum, over all its segmentations into pieces of an
existing unigram vocabulary, of the products of the pieces' weights, by a forward recursion in log
space. Weights come from the vocabulary's scores, which are ranks here, so a weight falls with the rank.
Ranks alone fit the corpus badly, so one round of expectation maximisation follows: forward and backward
recursions over every distinct training word give the expected count of each piece. Measured at sf0.1, sums
over the held-out texts: -1,900,590 by ranks alone, -1,737,158 after one round, -1,729,588 after a second,
which is not worth its time. A piece that begins a word carries the word's start, characters that no piece
covers are spelled in bytes, and weights sum to 1, so the lattice is a distribution over words. In a text,
words seen in training also have an arc of their own; the share of that arc follows the number of distinct
words (Witten and Bell), and an end token closes the text. The score is log10 of the text's probability,
summed over all segmentations.

Training words are counted in each task before they are dealt out. Scores of at most MOST_COMMON words, a
fixed number, are shipped to the tasks; the other words of each document are joined with the table of
words and summed again. Both ways give a word the same score.

Null and empty texts are one end token; a table without rows gives none. A long text is counted into its
distinct words before anything is sent on. Rows equal in id and text are scored alike, each for itself. A
null id is hashed as empty text. Without training tokens, words and ends are held equally likely. Other
input columns are not read, so none clashes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sitefold.llm.common import documents, materialise, row_key

MOST_COMMON = 1 << 17
#: Distinct words that a task holds while counting.
MOST_HELD = 400_000
#: Rounds of fitting, expected count added to each piece, and the rank from which first weights fall.
ROUNDS, ADDED, FLAT = 1, 0.01, 10.0
#: The end token in tables of words; no word is empty.
END = b""

_LN10 = math.log(10)


def load_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, first weight) of a sentencepiece file; a leading space marks a word's start.

    Bytes are the last 256 entries. Control pieces and pieces with inner word starts are left out.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) or "▁" in piece[1:]:
            continue
        found.append((piece.replace("▁", " "), 1 / (FLAT - sp.get_score(i))))
    if " " not in dict(found):
        found.append((" ", 1e-3))
    total = sum(w for _, w in found)
    return [(p, 0.99 * w / total) for p, w in found] + [(f"<{b}>", 0.01 / 256) for b in range(256)]


class Lattice:
    """pieces and weights as from load_pieces."""

    def __init__(self, pieces: list[str], weights: list[float]):
        self.root: dict = {}
        self.byte0 = len(pieces) - 256
        self.log = [math.log(w) for w in weights]
        for k, p in enumerate(pieces[: self.byte0]):
            node = self.root
            for c in p:
                node = node.setdefault(c, {})
            node[""] = k

    def _spelled(self, c: str) -> float:
        return sum(self.log[self.byte0 + b] for b in c.encode())

    def arcs(self, word: str) -> list[tuple[int, int, float, int]]:
        """(from, to, log weight, piece or -1 for bytes), by from."""
        s, root, log, out = " " + word, self.root, self.log, []
        n = len(s)
        for i in range(n):
            node, alone = root, False
            for j in range(i, n):
                node = node.get(s[j])
                if node is None:
                    break
                k = node.get("")
                if k is not None:
                    out.append((i, j + 1, log[k], k))
                    alone |= j == i
            if not alone:
                out.append((i, i + 1, self._spelled(s[i]), -1))
        return out

    def log_probability(self, word: str) -> float:
        """Natural log of the word's probability, over all segmentations."""
        s, root, log, exp, ln = " " + word, self.root, self.log, math.exp, math.log
        n = len(s)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        into[0].append(0.0)
        for i in range(n):
            v = into[i]
            if len(v) == 1:
                a = v[0]
            else:
                top = max(v)
                a = top + ln(sum([exp(x - top) for x in v]))
            node, alone = root, False
            for j in range(i, n):
                node = node.get(s[j])
                if node is None:
                    break
                k = node.get("")
                if k is not None:
                    into[j + 1].append(a + log[k])
                    if j == i:
                        alone = True
            if not alone:
                into[i + 1].append(a + self._spelled(s[i]))
        v = into[n]
        top = max(v)
        return top + ln(sum([exp(x - top) for x in v]))

    def expect(self, word: str, times: int, into: list[float]) -> None:
        """Adds times the expected count of each piece in the word."""
        arcs = self.arcs(word)
        n = len(word) + 1
        exp, ln = math.exp, math.log
        lists: list[list[float]] = [[] for _ in range(n + 1)]
        lists[0].append(0.0)
        alpha, at, a = [0.0] * (n + 1), -1, 0.0
        for i, j, w, _ in arcs:
            if i != at:
                v = lists[i]
                if len(v) == 1:
                    a = v[0]
                else:
                    top = max(v)
                    a = top + ln(sum([exp(x - top) for x in v]))
                alpha[i] = a
                at = i
            lists[j].append(a + w)
        v = lists[n]
        top = max(v)
        total = top + ln(sum([exp(x - top) for x in v]))
        beta, at, v = [0.0] * (n + 1), n, []
        s = None
        for i, j, w, k in reversed(arcs):
            if i != at:
                if len(v) == 1:
                    beta[at] = v[0]
                elif v:
                    top = max(v)
                    beta[at] = top + ln(sum([exp(x - top) for x in v]))
                at, v = i, []
            x = w + beta[j]
            v.append(x)
            share = times * exp(alpha[i] + x - total)
            if k >= 0:
                into[k] += share
            else:
                s = s or " " + word
                for b in s[i].encode():
                    into[self.byte0 + b] += share


def held_out(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def count_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, c): every word of all documents and END, with its number in those that aren't held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other = Counter(), set()

        def out() -> pa.RecordBatch:
            rest = [w for w in other if w not in train]
            got = pa.RecordBatch.from_arrays([pa.array([*train, *rest], pa.binary()), pa.array([*train.values(), *([0] * len(rest))], pa.int64())], names=["word", "c"])
            train.clear()
            other.clear()
            return got

        for b in batches:
            for held, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if held:
                    other.update(_words(t))
                else:
                    train.update(_words(t))
                    train[END] += 1
                if len(train) + len(other) > MOST_HELD:
                    yield out()
        yield out()

    counted = docs.select(held_out(key), F.col(text)).mapInArrow(run, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def fit(table: DataFrame, pieces: list[tuple[str, float]], rounds: int = ROUNDS) -> list[float]:
    """Weights after rounds of expectation maximisation over the training words. Only as many numbers
    as the vocabulary has pieces come to the driver."""
    names, weights = [p for p, _ in pieces], [w for _, w in pieces]
    for _ in range(rounds):
        shipped = table.sparkSession.sparkContext.broadcast((names, weights))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*shipped.value)
            expected = [0.0] * len(lattice.log)
            for b in batches:
                for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    lattice.expect(w.decode(), c, expected)
            some = [k for k, x in enumerate(expected) if x]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([expected[k] for k in some], pa.float64())], names=["piece", "expected"])

        rows = table.where((F.col("c") > 0) & (F.octet_length("word") > 0)).select("word", "c").mapInArrow(run, "piece int, expected double")
        expected = dict(rows.groupBy("piece").agg(F.sum("expected")).collect())
        total = sum(expected.values()) + ADDED * len(names)
        weights = [(expected.get(k, 0.0) + ADDED) / total for k in range(len(names))]
        shipped.unpersist()
    return weights


def token_score(c: int, lattice: float | None, n: int, v: int) -> tuple[float, float]:
    """(base, model) log10 probabilities of a token seen c times; lattice is None for END."""
    base = math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    if n == 0:
        return base, math.log10(0.5) + (lattice / _LN10 if lattice is not None else 0.0)
    known = c / (n + v)
    if lattice is None:
        return base, math.log10(known if c else 0.1 / (n + v))
    rest = math.log(v / (n + v)) + lattice
    if not c:
        return base, rest / _LN10
    top = math.log(known)
    return base, (max(top, rest) + math.log1p(math.exp(-abs(top - rest)))) / _LN10


def score_words(table: DataFrame, names: list[str], weights: list[float], n: int, v: int) -> DataFrame:
    """(word, c, base, score): both log10 probabilities of every word."""
    shipped = table.sparkSession.sparkContext.broadcast((names, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shipped.value)
        for b in batches:
            rows = [token_score(c, lattice.log_probability(w.decode()) if w else None, n, v) for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([r[k] for r in rows], pa.float64()) for k in (0, 1))], names=["word", "c", "base", "score"])

    return table.select("word", "c").mapInArrow(run, "word binary, c bigint, base double, score double")


def most_common_words(table: DataFrame, most: int) -> DataFrame:
    """Words of a count or more, the least count that leaves at most `most`.

    Counts are summed by eighths of powers of two, so that neither the driver nor a task sees more than the
    words that are taken, however many there are.
    """
    step = F.floor(8 * F.log2("c")).alias("step")
    least, held = None, 0
    for r in table.where("c > 0").groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).orderBy(F.desc("step")).collect():
        held += r.n
        if held > most:
            break
        least = r.c
    return table.where(F.lit(False) if least is None else F.col("c") >= least)


def score(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, most_common: int = MOST_COMMON) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    counts = materialise(count_words(docs, key, text), "word-counts")
    n, v = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    pieces = load_pieces(path)
    weights = fit(counts, pieces, rounds)
    table = materialise(score_words(counts, [p for p, _ in pieces], weights, n, v), "word-scores")
    common = {bytes(r.word): (True, r.base, r.score) for r in most_common_words(table, most_common).collect()}
    ends = table.where(F.octet_length("word") == len(END)).first()
    end = (ends.c > 0, ends.base, ends.score) if ends else (False, *token_score(0, None, n, v))
    shipped = spark.sparkContext.broadcast((common, end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of sums for each document, and a row for each rarer word of it."""
        common, end = shipped.value
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
        names = ["k", "n_tokens", "n_known", "base", "score", "word", "times"]
        for b in batches:
            cols: list[list] = [[] for _ in kinds]
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = _words(t)
                known, base, total, rare = int(end[0]), end[1], end[2], []
                for w, times in Counter(words).items():
                    if (x := common.get(w)) is not None:
                        known += times * x[0]
                        base += times * x[1]
                        total += times * x[2]
                    else:
                        rare.append((w, times))
                # A document's own row has a word that holds a space, so it joins nothing and goes anywhere.
                for row in ((k, len(words) + 1, known, base, total, b" " + k, 0), *((k, 0, 0, 0.0, 0.0, w, times) for w, times in rare)):
                    for col, x in zip(cols, row):
                        col.append(x)
                if len(cols[0]) > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
                    cols = [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    rows = docs.select(row_key(key, text).alias("k"), F.col(text)).mapInArrow(run, "k binary, n_tokens bigint, n_known bigint, base double, score double, word binary, times bigint")
    rows = rows.select("k", "n_tokens", F.col("n_known").alias("_n"), F.col("base").alias("_b"), F.col("score").alias("_s"), "word", "times")
    joined = rows.join(table, "word", "left")
    times = F.col("times")
    part = joined.select(
        "k", "n_tokens", (F.col("_n") + F.when(F.col("c") > 0, times).otherwise(0)).alias("n_known"),
        (F.col("_b") + F.coalesce(times * F.col("base"), F.lit(0.0))).alias("base"), (F.col("_s") + F.coalesce(times * F.col("score"), F.lit(0.0))).alias("score"),
    )
    # Rows equal in id and text come as often here as in the input; their sums are divided again.
    sums = part.groupBy("k").agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"), F.sum((F.col("n_tokens") > 0).cast("long")).alias("_rows"))
    sums = sums.select("k", (F.col("n_tokens") / F.col("_rows")).cast("long").alias("n_tokens"), (F.col("n_known") / F.col("_rows")).cast("long").alias("n_known"), (F.col("base_score") / F.col("_rows")).alias("base_score"), (F.col("score") / F.col("_rows")).alias("score"))
    out = docs.select(F.col(key), row_key(key, text).alias("k"), held_out(key).alias("held_out")).join(sums, "k")
    return out.select(key, "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
