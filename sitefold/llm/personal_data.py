"""Personal data: candidates of many generators, judged by boosted trees over format and context.

Generators (GENERATORS) are patterns of high recall; their spans may overlap. Four of them are base kinds: a base match
that passes its check is personal data whatever the model says. The others propose what the base patterns leave:
numbers beside other digits, numbers without a plus sign, spelled-out addresses, longer network addresses, account and
social security numbers. Trees over the features below give each candidate a probability; it is redacted from its
generator's threshold on, if no base span and no likelier candidate overlaps it.

The trees are fitted here, by gradient boosting, on labelled candidates: base candidates of all documents, labelled
by their checks and counted by equal features, of which the MOST_LABELLED commonest enter; and candidates of the
sentences in SEEDS, whose digits are drawn by a hash. A fifth of either is held out, and probabilities are calibrated
on it for each generator: its threshold is the lowest probability that is calibrated to PRECISION; without one the
generator adds nothing. The fitted trees become one SQL expression.

Everything is a projection of SQL functions over the whole text. A pattern's matches are set between marks, and
the text is split there once, so that places are sums of lengths. Patterns start only where a run of their characters
starts and give nothing back, so that time grows with the text. Places are code points, ends exclusive.

Null text counts as empty; an empty text has no spans, an empty table no rows (the model then comes from SEEDS alone).
Rows are judged one by one, so ties and repeats do not matter; a null id is an ordinary one. A text is read
whole, however long. detect() returns key and spans only; redact() keeps all columns and replaces the text. No name clashes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import exp

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sitefold.llm.common import documents, fresh, materialise

#: Candidates with different features that enter the fit, at most; the commonest do.
MOST_LABELLED = 20_000
#: Trees, their depth, and the share of held-out weight above a threshold that must be personal data.
TREES, DEPTH, PRECISION = 20, 3, 0.95
#: Characters of context on either side.
CONTEXT = 32

# Kinds in the order of their spans, the base ones first.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
N_BASE = 4

#: Marks that no pattern can match; the first is replaced by the second where a text holds it.
MARK, OTHER = "\x01", "\x02"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(m: Column, low: int, high: int) -> Column:
    return F.length(_digits(m)).between(low, high)


def luhn(m: Column) -> Column:
    """Whether the digits' check sum holds."""

    def total(d: Column) -> Column:
        last = F.length(d) - 1
        value = lambda i: F.substring(d, i + 1, F.lit(1)).cast("int")
        doubled = lambda i: F.when((last - i) % 2 == 1, value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)).otherwise(value(i))
        return F.aggregate(F.sequence(F.lit(0), last), F.lit(0), lambda a, i: a + doubled(i)) % 10 == 0

    return _let(_digits(m), total)


def _card(low: int) -> Callable[[Column], Column]:
    return lambda m: F.when(_count(m, low, 19), luhn(m)).otherwise(False)


def _iban(m: Column) -> Column:
    """Whether the number, its first four characters put last and letters read as 10 to 35, leaves 1 of 97."""

    def left(s: Column) -> Column:
        code = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        step = lambda a, c: _let(code(c), lambda v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
        return F.aggregate(F.split(s, ""), F.lit(0), step) == 1

    return _let(F.regexp_replace(m, " ", ""), lambda s: left(F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))))


@dataclass(frozen=True)
class Generator:
    name: str
    kind: str
    pattern: str
    #: A text without any of these strings has no match.
    needs: str
    check: Callable[[Column], Column]
    #: Words before a candidate that speak for it.
    cues: str
    #: Whether a candidate that passes the check is personal data, and one that does not is none. None: not known.
    labelled: bool = True


_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_MAIL, _CALL, _PAY = "mail|contact|write|reach", "tel|phone|call|mobile|cell|fax|ring|dial|whatsapp|text me", "card|visa|master|amex|credit|pay|account|bank|iban"

# The first four patterns. Runs start where no character of theirs stands before, or where the last match ended.
GENERATORS = (
    Generator("email", "email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@", lambda m: F.lit(True), _MAIL),
    Generator("ip", "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]\\.[0-9]", lambda m: m.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"), "ip|address|host|server|from"),
    Generator("card", "card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){12,}+", "[0-9][ 0-9-]{12}", _card(16), _PAY),
    Generator("phone", "phone", r"\+[0-9][ ().0-9-]+[0-9]", "\\+[0-9]", lambda m: _count(m, 8, 15), _CALL),
    Generator("card_part", "card", r"(?<![0-9])(?:[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])", "[0-9][ 0-9-]{12}", _card(13), _PAY),
    Generator("phone_part", "phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])", "\\+[0-9]", lambda m: _count(m, 8, 15), _CALL),
    Generator("phone_plain", "phone", r"(?<![0-9+(.,-])(?<![0-9+)][ .-])(?:\([0-9]{2,5}\) ?|[0-9]{3,5}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])(?![.,-][0-9])", "[0-9][ .)-]", lambda m: _count(m, 7, 13), _CALL, False),
    Generator("email_words", "email", rf"(?<!{_LOCAL}){_LOCAL}++(?: ?[\[({{] ?(?:at|@) ?[\])}}] ?| at ){_LABEL}++(?:(?: ?[\[({{] ?(?:dot|\.) ?[\])}}] ?| dot ){_LABEL}++)++", "[ \\[({](?:dot|\\.)[ \\])}]", lambda m: m.rlike("[a-z]{2,10}$"), _MAIL, False),
    Generator("ip_long", "ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])", "[0-9A-Fa-f]:", lambda m: m.rlike("^[^:]+(?::[^:]+){7}$") | m.rlike("^[^:]+(?::[^:]+)+::[^:]+(?::[^:]+)*$"), "ip|address|host|server|from", False),
    Generator("iban", "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z][A-Z][0-9][0-9]", _iban, _PAY),
    Generator("ssn", "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), "ssn|social|security", False),
)

#: Words before a number that speak against personal data.
AGAINST = "isbn|issn|order|version|invoice|page|ref|no\\.|number|doi|year|lot|serial|model|part|case|item|ticket|sku|build|between|score"

#: Labelled sentences: # is any digit. All candidates in one have its label.
SEEDS = (
    (True, "Please call 0### ### #### before noon."),
    (True, "Tel: (0##) ###-####"),
    (True, "my mobile is 07### ### ###"),
    (True, "phone ###-###-####, ask for me"),
    (True, "You can text me: ### ### ####."),
    (True, "Fax (###) ###-####\n"),
    (True, "dial 0## ## ## ## ##"),
    (True, "ring +1 (###) 555-#### at home"),
    (True, "jane.doe## at example dot org"),
    (True, "write to j#mith (at) mail (dot) example (dot) com"),
    (True, "contact sales#[at]example[dot]net"),
    (True, "reach me under sam.field at mailbox dot net"),
    (True, "contact lee_moor at sample dot com"),
    (True, "from 2001:db8:##:0:0:##:0:1##"),
    (True, "her host 2001:db8::##:1## was seen"),
    (True, "his SSN is 1##-4#-1###."),
    (True, "social security 2##-1#-2###"),
    (True, "born here, 3##-5#-3###, lives there"),
    (True, "IBAN DE89 3704 0044 0532 0130 00"),
    (True, "pay into GB82 WEST 1234 5698 7654 32"),
    (True, "account FR1420041010050500013M02606"),
    (True, "Visa 4111 1111 1111 1111 exp ##"),
    (True, "card 5555555555554444"),
    (True, "amex 3782 822463 10005"),
    (False, "order 0### ### #### was shipped"),
    (False, "invoice ###-###-#### of the year"),
    (False, "ISBN 978 3 16 148410 # and 0### #### ###"),
    (False, "the table says 1### 2### 3### 4### by row"),
    (False, "between 19## 19## 20## 20## we grew"),
    (False, "part 4###-###-### of the model"),
    (False, "values 1## 2## 3## 4## were found"),
    (False, "scores 2###.##.## and 3###-##-##"),
    (False, "on 20##-0#-1# 1### ### ##"),
    (False, "we met at noon dot and line"),
    (False, "at 1#:2#:3#:4# the clock"),
    (False, "ratio 1#:2#:3#, and 4:5:6:7"),
    (False, "lot 9##-0#-0000 and item 000-1#-####"),
    (False, "ref AB12 3### 4### 5### 6###"),
    (False, "number 1### 2### 3### 4##1 in serial"),
    (False, "build 4###-5###-6###-7#"),
)
#: Sentences made of each seed.
EACH = 24


# --- candidates -------------------------------------------------------------------------------------------------

#: Items whose sums are run through at once; arrays that grow item by item are copied each time.
STRIDE = 256


def running(lengths: Column) -> Column:
    """Sums of all items before each, in stretches, so that time grows with the power 1.5 of their number."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / STRIDE).cast("int"))
    stretch = lambda b: F.slice(lengths, b * STRIDE + 1, F.lit(STRIDE))
    last = lambda a: F.element_at(a, -1)
    total = lambda b: F.aggregate(stretch(b), F.lit(0), lambda a, x: a + x)
    starts = F.aggregate(numbers, F.array(F.lit(0)), lambda a, b: F.concat(a, F.array(last(a) + total(b))))
    sums = lambda s, b: F.aggregate(stretch(b), F.array(F.get(s, b)), lambda a, x: F.concat(a, F.array(last(a) + x)))
    return _let(starts, lambda s: F.flatten(F.transform(numbers, lambda b: F.slice(sums(s, b), F.lit(1), F.size(stretch(b))))))


def _pieces(text: Column, g: Generator) -> Column:
    """What stands before, in and behind the matches, in turn; null for a text without one."""
    marked = F.regexp_replace(text, F.lit(g.pattern), F.lit(f"{MARK}$0{MARK}"))
    return F.when(text.contains("@") if g.needs == "@" else text.rlike(g.needs), F.split(marked, MARK))


CANDIDATE = "struct<g:int,start:int,end:int,m:string,before:string,after:string>"


def candidates(text: Column) -> Column:
    """All generators' matches: generator, place, matched string and context."""
    body = F.when(text.contains(MARK), F.translate(text, MARK, OTHER)).otherwise(text)
    all_pieces = _let(body, lambda t: F.array(*[F.struct(F.lit(k).alias("g"), _pieces(t, g).alias("p")) for k, g in enumerate(GENERATORS)]))

    def one(x: Column) -> Column:
        p = x["p"]
        at = lambda s, k: F.struct(
            x["g"].alias("g"),
            F.get(s, k).alias("start"),
            (F.get(s, k) + F.length(F.get(p, k))).alias("end"),
            F.get(p, k).alias("m"),
            F.right(F.get(p, k - 1), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(p, k + 1), F.lit(CONTEXT)).alias("after"),
        )
        odd = F.sequence(F.lit(1), F.size(p) - 2, F.lit(2))
        return _let(F.transform(p, F.length), lambda n: _let(running(n), lambda s: F.transform(odd, lambda k: at(s, k))))

    some = F.filter(all_pieces, lambda x: F.coalesce(F.size(x["p"]), F.lit(0)) > 2)
    return F.flatten(F.transform(some, one)).cast(f"array<{CANDIDATE}>")


def _by_generator(c: Column, of: Callable[[Generator], Column | None], default) -> Column:
    out = F.lit(default)
    for k, g in enumerate(GENERATORS):
        value = of(g)
        if value is not None:
            out = F.when(c["g"] == k, value).otherwise(out)
    return out


def valid(c: Column) -> Column:
    return _by_generator(c, lambda g: g.check(c["m"]), False)


_flag = lambda x: F.coalesce(x, F.lit(False)).cast("int")

#: Features beside one for each generator; all are small integers.
FEATURES = {
    "valid": lambda c: _flag(valid(c)),
    "digits": lambda c: F.least(F.length(_digits(c["m"])), F.lit(40)),
    "groups": lambda c: F.least(F.regexp_count(c["m"], F.lit("[0-9]+")), F.lit(12)),
    "letters": lambda c: F.least(F.length(F.regexp_replace(c["m"], "[^A-Za-z]", "")), F.lit(20)),
    "separators": lambda c: F.size(F.array_distinct(F.split(F.regexp_replace(c["m"], "[A-Za-z0-9]", ""), ""))),
    "cue": lambda c: _flag(_by_generator(c, lambda g: F.lower(c["before"]).rlike(rf"\b(?:{g.cues})"), False)),
    "against": lambda c: _flag(F.lower(c["before"]).rlike(rf"\b(?:{AGAINST})")),
    "glued_left": lambda c: _flag(c["before"].rlike("[A-Za-z0-9_$%&*|#/]$")),
    "glued_right": lambda c: _flag(c["after"].rlike("^[A-Za-z0-9_$%&*|#/]")),
    "digits_near": lambda c: F.least(F.length(_digits(F.concat(c["before"], c["after"]))), F.lit(8)),
}
NAMES = tuple(FEATURES) + tuple(f"is_{g.name}" for g in GENERATORS)


def features(c: Column) -> Column:
    own = [f(c).cast("int").alias(n) for n, f in FEATURES.items()]
    return F.struct(*own, *[(c["g"] == k).cast("int").alias(f"is_{g.name}") for k, g in enumerate(GENERATORS)])


# --- model ------------------------------------------------------------------------------------------------------

Tree = float | tuple[str, float, "Tree", "Tree"]


@dataclass(frozen=True)
class Model:
    """Trees whose leaves add up to half the log odds, and a threshold for each generator (above 1: none is taken)."""

    trees: tuple[Tree, ...]
    thresholds: tuple[float, ...]

    def probability(self, x: Column) -> Column:
        def column(t: Tree) -> Column:
            if isinstance(t, float):
                return F.lit(t)
            return F.when(x[t[0]] <= t[1], column(t[2])).otherwise(column(t[3]))

        margin = F.lit(0.0)
        for t in self.trees:
            margin = margin + column(t)
        return F.lit(1.0) / (1.0 + F.exp(-2.0 * margin))

    def plain(self, x: dict[str, int]) -> float:
        """probability() of one candidate's features on the driver."""

        def leaf(t: Tree) -> float:
            while not isinstance(t, float):
                t = t[2] if x[t[0]] <= t[1] else t[3]
            return t

        return 1 / (1 + exp(-2 * sum(map(leaf, self.trees))))


def seeds(spark: SparkSession) -> DataFrame:
    """(label, text, fold) of the sentences made of SEEDS."""
    rows = spark.range(EACH, numPartitions=1).select("id", F.explode(F.array(*[F.struct(F.lit(label).alias("label"), F.lit(s).alias("s"), F.lit(k).alias("k")) for k, (label, s) in enumerate(SEEDS)])).alias("x"))
    digit = lambda c, i: F.when(c == "#", F.pmod(F.xxhash64("x.k", "id", i), F.lit(10)).cast("string")).otherwise(c)
    return rows.select("x.label", F.array_join(F.transform(F.split("x.s", ""), digit), "").alias("text"), (F.col("id") % 5 == 0).alias("held"))


def labelled(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(features, label, held, weight): candidates with equal features are one row. Each generator's positive and
    negative candidates of documents and of SEEDS weigh the same together."""
    known = [k for k, g in enumerate(GENERATORS) if g.labelled]
    of_docs = docs.select((F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0).alias("held"), F.explode(candidates(F.col(text))).alias("c")).where(F.col("c.g").isin(known))
    of_docs = of_docs.select("held", features(F.col("c")).alias("f")).select("held", "f", (F.col("f.valid") == 1).alias("label"), F.lit(False).alias("seed"))
    of_docs = of_docs.groupBy("held", "f", "label", "seed").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "f", "held").limit(MOST_LABELLED)
    made = seeds(docs.sparkSession).select("held", "label", F.explode(candidates(F.col("text"))).alias("c"))
    made = made.groupBy("held", features(F.col("c")).alias("f"), "label", F.lit(True).alias("seed")).agg(F.count(F.lit(1)).alias("n"))
    rows = materialise(of_docs.unionByName(made).coalesce(1), "labelled-candidates")
    g = F.array_position(F.array(*[F.col(f"f.is_{x.name}") for x in GENERATORS]), 1)
    group = rows.groupBy(g.alias("_g"), "label", "seed").agg(F.sum("n").alias("_n"))
    out = rows.withColumn("_g", g).join(F.broadcast(group), ["_g", "label", "seed"])
    return materialise(out.select("f.*", "label", "held", (1000 * F.col("n") / F.col("_n")).alias("weight")).coalesce(1), "weighted-candidates")


def _tree(node, weight: float) -> Tree:
    """A fitted tree as nested tuples."""
    if node.subtreeDepth() == 0:
        return weight * node.prediction()
    s = node.split()
    return NAMES[s.featureIndex()], s.threshold(), _tree(node.leftChild(), weight), _tree(node.rightChild(), weight)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    rows = labelled(docs, key, text)
    rows = rows.withColumn("label", F.col("label").cast("double"))
    table = VectorAssembler(inputCols=list(NAMES), outputCol="x").transform(rows.where("NOT held"))
    fitted = GBTClassifier(featuresCol="x", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.3, seed=1).fit(table)
    trees = tuple(_tree(t._call_java("rootNode"), w) for t, w in zip(fitted.trees, fitted.treeWeights))
    model = Model(trees, ())
    held = rows.where("held").collect()  # MOST_LABELLED and the seeds' at most
    return Model(trees, tuple(_threshold([(model.plain(r.asDict()), r["label"], r["weight"]) for r in held if r[f"is_{g.name}"]]) for g in GENERATORS))


def _threshold(scored: list[tuple[float, float, float]]) -> float:
    """The lowest probability whose calibrated value is PRECISION at least; 2 without one.

    scored has (probability, label, weight). Calibrated values are the shares of positive weight, pooled until they rise
    with the probability (isotonic regression); equal probabilities are pooled from the start.
    """
    total = [sum(w for _, y, w in scored if y == side) or 1 for side in (0, 1)]  # both sides weigh the same
    pools: list[list[float]] = []  # lowest probability, positive weight, weight
    for p, label, weight in sorted(scored):
        weight /= total[int(label)]
        pools.append([p, label * weight, weight])
        while len(pools) > 1 and (pools[-2][0] == pools[-1][0] or pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]):
            _, good, all_ = pools.pop()
            pools[-1][1] += good
            pools[-1][2] += all_
    return min((p for p, good, all_ in pools if good >= PRECISION * all_), default=2.0)


# --- spans ------------------------------------------------------------------------------------------------------

SPANS = "array<struct<kind:int,start:int,end:int>>"
KIND_OF = tuple(KINDS.index(g.kind) for g in GENERATORS)


def _chosen(judged: Column) -> Column:
    """Of spans (start, end, rank, base, kind) by start, those added: no base span overlaps them, and of overlapping
    ones the higher rank stays. One pass from left to right."""
    none = F.lit(None).cast("struct<start:int,end:int,rank:double,base:boolean,kind:int>")
    start = F.struct(F.array().cast("array<struct<start:int,end:int,rank:double,base:boolean,kind:int>>").alias("done"), none.alias("last"), F.lit(0).alias("until"))

    def step(a: Column, x: Column) -> Column:
        meets = a["last"].isNotNull() & (x["start"] < a["last"]["end"])
        pushed = F.when(a["last"].isNull() | meets, a["done"]).otherwise(F.concat(a["done"], F.array(a["last"])))
        better = F.when(meets & (a["last"]["rank"] >= x["rank"]), a["last"]).otherwise(x)
        as_base = F.struct(pushed.alias("done"), none.alias("last"), F.greatest(a["until"], x["end"]).alias("until"))
        as_added = F.struct(pushed.alias("done"), better.alias("last"), a["until"].alias("until"))
        return F.when(x["base"], as_base).when(x["start"] < a["until"], a).otherwise(as_added)

    return F.aggregate(judged, start, step, lambda a: F.when(a["last"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["last"]))))


def spans(text: Column, model: Model) -> Column:
    """struct<base, added>, each by kind, then start."""
    kind = F.array(*[F.lit(k) for k in KIND_OF])
    least = F.array(*[F.lit(t) for t in model.thresholds])

    def judge(c: Column) -> Column:
        base = (c["g"] < N_BASE) & valid(c)
        p = F.when(base, 2.0).otherwise(_let(features(c), model.probability))
        # Of equally likely spans the longer one stays.
        return _let(p, lambda p: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.when(p >= F.get(least, c["g"]), p + (c["end"] - c["start"]) * 1e-9).alias("rank"), base.alias("base"), F.get(kind, c["g"]).alias("kind")))

    judged = F.filter(F.transform(candidates(text), judge), lambda x: x["rank"].isNotNull())
    # A base span comes before others of its start.
    order = lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(F.when(a["base"] & ~b["base"], -1).when(b["base"] & ~a["base"], 1).when(a["end"] != b["end"], b["end"] - a["end"]).otherwise(a["kind"] - b["kind"]))
    bare = lambda found: F.array_sort(F.transform(found, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))
    both = lambda j: F.struct(bare(F.filter(j, lambda x: x["base"])).alias("base"), bare(_chosen(F.array_sort(j, order))).alias("added"))
    return _let(judged, both)


def detect(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, base and added spans of every row: one projection, no shuffle."""
    # The spans pass through a generator of one row, so that nothing above computes them once more.
    return docs.select(F.col(key), F.inline(F.array(spans(F.col(text), model))))


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with every span, overlapping ones as one, replaced by the name of the first one's kind in brackets."""
    (at,) = fresh(docs.columns, "_spans")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    found = lambda s: F.array_sort(F.transform(F.concat(s["base"], s["added"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    body = F.col(text)

    def step(a: Column, x: Column) -> Column:
        more = F.concat(a["out"], F.substring(body, a["at"] + 1, x["start"] - a["at"]), F.get(names, x["kind"]))
        fresh_one = F.struct(more.alias("out"), x["end"].alias("at"))
        return F.when(x["start"] >= a["at"], fresh_one).otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], x["end"]).alias("at")))

    cut = F.aggregate(F.col(at), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda a: F.concat(a["out"], F.substring(body, a["at"] + 1, F.length(body))))
    rows = docs.select("*", F.inline(F.array(F.struct(_let(spans(body, model), found).alias(at)))))
    return rows.withColumn(text, F.when(F.size(at) > 0, cut).otherwise(body)).drop(at)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as one string."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    label = lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        F.col(key),
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(N_BASE)],
        F.sha2(F.array_join(F.transform("base", label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(F.array_sort(F.concat("base", "added")), label), ",").alias("spans"),
    )


def op12(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return digest(detect(docs, fit(docs)))
