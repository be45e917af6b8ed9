"""Secret scans: fixed patterns, and Markov models that tell random strings from identifiers.

Base spans come from three patterns.  Candidates are long runs of key characters outside of them.
Two first-order Markov models over characters are trained on every distinct labelled string of the
corpus: random ones are the values of base spans, ordinary ones the candidates that consist of
words and numbers.  A candidate whose log-likelihood ratio exceeds a threshold adds a span of kind
`random`.  DataFrame operations only.

Positions are code points, end exclusive.  Defined cases: a null or empty text has no span; a very
long text is scanned whole; repeated rows each get their spans, but count once for training; an
empty table gives no rows; without any base span the ratio knows no random strings and adds nothing; columns other than doc_id and text are not read by `scan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from star_marts.llm.common import let, whole_text
from star_marts.session import stage

# The kinds in the order in which spans at one place are listed, and their patterns.
# A run of hex or access characters that is long enough is found by its length alone.
KINDS = ["assign", "access", "hex"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6

CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
_PART = "(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)"
ORDINARY = f"^{_PART}(?:[+/_-]+{_PART})*$"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SMOOTHING = 8.0
LEAST_RATIO = 12.0  # nats by which a random string must be likelier than an identifier
_WIDTH = len(ALPHABET) + 1  # code 0 stands for the start


def _located(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value): leftmost non-overlapping matches; `value` is a group's text.

    The text between matches comes from splitting by the same pattern, so a match starts after
    all earlier gaps and matches.
    """
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    parts = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("match"),
        (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found).alias("value"),
    )
    empty = F.lit(None).cast("array<struct<start:int,end:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), F.coalesce(empty, F.array()).alias("spans"))

    def step(state: Column, part: Column) -> Column:
        first = state["at"] + F.length(part["gap"])
        last = first + F.length(part["match"])
        span = F.struct(first.alias("start"), last.alias("end"), part["value"].alias("value"))
        return F.struct(last.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(parts, start, step)["spans"]).otherwise(
        F.coalesce(empty, F.array())
    )


def _base(text: Column) -> Column:
    """Array of (start, kind number, end, value), in order; the value is what is secret."""
    assigned = F.filter(_located(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_ASSIGNED)
    kinds = [assigned, _located(text, ACCESS), _located(text, HEX)]
    return F.array_sort(F.concat(*[_of_kind(spans, n) for n, spans in enumerate(kinds)]))


def _of_kind(spans: Column, kind: int) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"], F.lit(kind).alias("kind"), s["end"], s["value"])
    )


def _candidates(text: Column, base: Column) -> Column:
    """Array of (start, kind number, end, value) of the candidates that touch no base span."""
    free = lambda spans: F.filter(
        _of_kind(_located(text, CANDIDATE), len(KINDS)),
        lambda c: ~F.exists(spans, lambda s: (s["start"] < c["end"]) & (s["end"] > c["start"])),
    )
    return let(base, free)


def _count(kind: int) -> Column:
    return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")


def labelled_strings(docs: DataFrame) -> DataFrame:
    """value and random, for every distinct string that is known to be either."""
    found = docs.select(whole_text().alias("text")).withColumn("base", _base(F.col("text")))
    both = F.concat(
        F.transform("base", lambda s: F.struct(s["value"], F.lit(True).alias("random"))),
        F.transform(
            F.filter(_candidates(F.col("text"), F.col("base")), lambda c: c["value"].rlike(ORDINARY)),
            lambda c: F.struct(c["value"], F.lit(False).alias("random")),
        ),
    )
    return found.select(F.inline(both)).distinct()


def _steps(value: Column) -> Column:
    """One number per character: its place in the alphabet, from 1, and that of the one before it, 0 at the start."""
    places = F.transform(
        F.sequence(F.lit(1), F.length(value)),
        lambda i: F.instr(F.lit(ALPHABET), F.substr(value, i, F.lit(1))),
    )
    return let(
        places,
        lambda p: F.zip_with(
            F.concat(F.array(F.lit(0)), F.slice(p, F.lit(1), F.size(p) - 1)), p,
            lambda before, here: before * _WIDTH + here,
        ),
    )


def log_ratios(strings: DataFrame) -> DataFrame:
    """One row, `ratios` (null if nothing is random): log P(next | previous) among random strings
    over that among ordinary ones.

    What follows a character is smoothed by what occurs at all, which counts as `SMOOTHING` further
    times, so that a character that ordinary strings never have tells something after any other.
    The array has a number for each pair of the alphabet, whatever the corpus; characters outside
    of it share the code of the start.
    """
    steps = strings.select("random", F.explode(_steps(F.col("value"))).alias("step"))
    counts = steps.groupBy("step").agg(
        F.count_if("random").alias("random"), F.count_if(~F.col("random")).alias("plain")
    )
    spark = strings.sparkSession
    grid = spark.range(_WIDTH * _WIDTH).select(F.col("id").cast("int").alias("step")).join(counts, "step", "left").select(
        "step", F.floor(F.col("step") / _WIDTH).alias("previous"), (F.col("step") % _WIDTH).alias("next"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("random", "plain")],
    )

    def likelihood(count: str) -> Column:
        total = lambda *by: F.sum(count).over(Window.partitionBy(*by))
        occurs = (total("next") + 0.5) / (total() + 0.5 * _WIDTH)
        return F.log((F.col(count) + SMOOTHING * occurs) / (total("previous") + SMOOTHING))

    any_random = F.max(F.col("random") > 0).alias("any")
    rated = grid.withColumn("ratio", likelihood("random") - likelihood("plain"))
    rows = rated.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("step", "ratio"))), lambda x: x["ratio"]).alias("ratios"),
        any_random,
    )
    return rows.select(F.when(F.col("any"), F.col("ratios")).alias("ratios"))


def with_spans(docs: DataFrame, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """`docs` with `_base` and `_random`, arrays of (start, kind number, end, value)."""
    strings = stage(labelled_strings(docs), "strings")
    # A number per pair of the alphabet comes to the driver, and goes into the plan as one literal.
    row = log_ratios(strings).first()["ratios"]
    numbers = ",".join(repr(float(x)) for x in row or [])
    ratios = F.split(F.lit(numbers), ",").cast("array<double>")
    likelier = lambda c: F.aggregate(
        _steps(c["value"]), F.lit(0.0), lambda total, step: total + F.get(ratios, step)
    )
    found = docs.withColumn("_base", _base(whole_text()))
    if row is None:
        return found.withColumn("_random", F.slice("_base", F.lit(1), F.lit(0)))
    free = _candidates(whole_text(), F.col("_base"))
    return found.withColumn("_random", F.filter(free, lambda c: likelier(c) >= least_ratio))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in [*KINDS, "random"]])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def scan(docs: DataFrame, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    spans = with_spans(docs.select("doc_id", "text"), least_ratio)
    counts = [_count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)]
    return spans.select(
        "doc_id", *counts, F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("_base", "_random"))).alias("spans"),
    )


def redact(docs: DataFrame, least_ratio: float = LEAST_RATIO, mask: str = "[secret]") -> DataFrame:
    """`docs` with every span, base or random, replaced by `mask`; overlapping spans by one."""
    # Apart from other columns, which may have any name.
    names = docs.columns
    whole = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)]).alias("_row")
    docs = docs.select(whole, docs["text"].alias("text"))
    spans = F.array_sort(F.concat("_base", "_random"))
    text = whole_text()
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] < state["at"], state["done"]).otherwise(
                F.concat(state["done"], gap, F.lit(mask))
            ).alias("done"),
        )

    done = F.aggregate(spans, start, step)
    rest = F.substr(text, done["at"] + 1)
    some = F.size("_base") + F.size("_random") > 0
    masked = F.concat(done["done"], rest)
    changed = {"text": F.when(some, masked).otherwise(F.col("text"))}
    changed["n_chars"] = F.when(some, F.length(masked).cast("long"))
    columns = []
    for i, name in enumerate(names):
        before = F.col("_row")[f"c{i}"]
        columns.append((F.coalesce(changed[name], before) if name in changed else before).alias(name))
    return with_spans(docs, least_ratio).select(*columns)
