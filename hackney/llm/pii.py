"""Personal data by weak supervision, in DataFrame operations only.

Base patterns (email, ip, card, phone) always stand.  Looser patterns propose
further spans; labelers vote on every span (base ones too) from its form, from
gazetteers and from the words around it: 1 (personal), -1 (not) or 0 (no
opinion).  Expectation-maximisation over the table of vote patterns estimates
each labeler's reliability, and its posteriors train a logistic classifier of
spans, which decides about the proposed ones.

The text work is SQL expressions on Spark.  The driver only sees the counts of
vote patterns, a table whose size is bounded by the numbers of kinds, labelers
and features, whatever the corpus; it fits a few dozen numbers and writes them
back into a SQL expression.

Positions: a pattern's matches are `regexp_extract_all`, the text between them
is `split`, and running sums of both lengths (in code points) are the offsets.
Quantifiers are possessive where nothing they give back could match, and
patterns that begin with a long run may begin only at the run's start or where
the last match ended, so long runs neither backtrack nor overflow the stack.

Edge cases: a null text is empty and has no spans; repeated rows are searched
one by one; an empty table gives an empty result and a classifier that accepts
nothing; columns other than id and text are not read by `find`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import apart, named_apart, stored, together

# The base patterns, in the order of their kinds.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Given names that are also in no common word list; two words make a name.
GIVEN_NAMES = ("James Mary Robert Patricia Jennifer Michael Linda David Elizabeth William Barbara Richard Susan "
               "Jessica Thomas Sarah Karen Charles Christopher Nancy Daniel Matthew Margaret Anthony Sandra "
               "Hans Klaus Jürgen Ursula Pierre Jacques François Camille José María Carmen Javier").split()
TOP_DOMAINS = "com org net edu gov mil int info io de fr es it uk us eu ch at nl ca au jp cn br in"
# Proposed spans, looked for where no base span is.
LOOSE = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]++"
              r"(?: ?[\[(] ?(?:dot|DOT) ?[\])] ?[A-Za-z0-9-]++)++"),
    "ip": r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9.])[0-9]{4}(?:\.[0-9]{4}){3}(?![0-9.])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": rf"(?<![\p{{L}}])(?:(?:Mr|Mrs|Ms|Dr)\. |(?:{'|'.join(GIVEN_NAMES)}) )\p{{Lu}}\p{{Ll}}++",
}
KINDS = [*BASE, "ssn", "name"]
# Words before a span that speak for or against it.
FOR = r"(?i)(?:phone|call|tel|mobile|fax|contact|e-?mail|write to|address|card|visa|mastercard|ssn|social security|name is|ip)[^\p{L}]{0,8}$"
AGAINST = r"(?i)(?:version|invoice|order|isbn|issn|serial|part|page|article|section|id|no|build)[^\p{L}]{0,8}$"

CHUNK = 64
CONTEXT = 48
SPAN = "array<struct<kind:string,start:int,stop:int,hit:string,before:string,after:string>>"


# ---- places of matches

# As SQL text: {h}its, {g}aps, {s}teps, {c}hunks, {o}ffsets are column names.
_STEPS = f"""transform({{h}}, (x, i) -> named_struct('skip', length(get({{g}}, i)), 'hit', x,
    'before', right(get({{g}}, i), {CONTEXT}), 'after', left(get({{g}}, i + 1), {CONTEXT})))"""
_CHUNKS = f"""transform(sequence(0, greatest(0, int(floor((size({{s}}) - 1) / {CHUNK})))), k -> slice({{s}}, k * {CHUNK} + 1, {CHUNK}))"""
# Where each chunk's text begins.
_OFFSETS = """aggregate(
    transform({c}, x -> aggregate(x, 0, (n, y) -> n + y.skip + length(y.hit))),
    named_struct('at', 0, 'out', cast(array() as array<int>)),
    (acc, n) -> named_struct('at', acc.at + n, 'out', concat(acc.out, array(acc.at))),
    acc -> acc.out)"""
_LOCATED = f"""flatten(zip_with({{c}}, {{o}}, (x, o) -> aggregate(x,
    named_struct('at', o, 'out', cast(array() as {SPAN})),
    (acc, y) -> named_struct('at', acc.at + y.skip + length(y.hit), 'out', concat(acc.out, array(named_struct(
        'kind', '{{kind}}', 'start', acc.at + y.skip, 'stop', acc.at + y.skip + length(y.hit),
        'hit', y.hit, 'before', y.before, 'after', y.after)))),
    acc -> acc.out)))"""


def _matches(df: DataFrame, text: str, patterns: dict[str, str], when: dict[str, Column], prefix: str) -> DataFrame:
    """``df`` with a column ``{prefix}{kind}`` of spans for each pattern; the
    cheap test ``when`` spares most texts the pattern.  Running sums go chunk
    by chunk, so the work is linear in a text's matches but for a small factor;
    each step is a column of its own, so that none is computed twice."""
    none = F.array().cast("array<string>")

    def layer(name: str, make: Callable[[str], Column]) -> None:
        nonlocal df
        df = df.withColumns({f"__{name}_{k}": make(k) for k in patterns})

    def of(name: str, kind: str) -> Column:
        return F.col(f"__{name}_{kind}")

    layer("hits", lambda k: F.when(when[k], F.regexp_extract_all(F.col(text), F.lit(patterns[k]), F.lit(0))).otherwise(none))
    layer("gaps", lambda k: F.when(F.size(of("hits", k)) > 0, F.split(F.col(text), patterns[k], -1)).otherwise(none))
    names = {k: {"h": f"__hits_{k}", "g": f"__gaps_{k}", "s": f"__steps_{k}", "c": f"__chunks_{k}", "o": f"__offsets_{k}", "kind": k}
             for k in patterns}
    for name, sql in (("steps", _STEPS), ("chunks", _CHUNKS), ("offsets", _OFFSETS)):
        layer(name, lambda k, sql=sql: F.expr(sql.format(**names[k])))
    df = df.withColumns({f"{prefix}{k}": F.expr(_LOCATED.format(**names[k])) for k in patterns})
    return df.drop(*[f"__{n}_{k}" for n in ("hits", "gaps", "steps", "chunks", "offsets") for k in patterns])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(hit)).between(13, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _any_valid(hit: Column) -> Column:
    """Whether a match of any base pattern is a base span."""
    return (F.when(hit.contains("@"), True).when(hit.startswith("+"), _valid("phone", hit))
            .when(hit.contains("."), _valid("ip", hit)).otherwise(_valid("card", hit)))


def _validity(kind: str) -> Callable[[Column], Column]:
    return lambda s: _valid(kind, s["hit"])


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def _spans(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``base`` and ``loose``: arrays of spans."""
    text = F.col(text_col)
    digits, marks = text.rlike("[0-9]"), text.contains("@")
    df = _matches(docs, text_col, BASE, {"email": marks, "ip": digits & text.contains("."), "card": digits,
                                         "phone": text.contains("+") & digits}, "__b_")
    base = F.concat(*[F.filter(F.col(f"__b_{k}"), _validity(k)) for k in BASE])
    df = df.withColumn("base", base).drop(*[f"__b_{k}" for k in BASE])
    # The same text with base matches blotted out, length for length.
    anything = "|".join(BASE.values())
    hits, gaps = F.regexp_extract_all(text, F.lit(anything), F.lit(0)), F.split(text, anything, -1)
    blot = F.array_join(F.zip_with(gaps, hits, lambda g, h: F.concat(
        g, F.coalesce(F.when(_any_valid(h), F.regexp_replace(h, r"(?s).", "\u0001")).otherwise(h), F.lit("")))), "")
    df = df.withColumn("__rest", F.when(F.size("base") > 0, blot).otherwise(text))
    rest = F.col("__rest")
    some = {k: rest.rlike(p) for k, p in LOOSE.items()}
    for k in ("ip", "card", "phone", "ssn"):
        some[k] = digits & some[k]
    df = _matches(df, "__rest", LOOSE, some, "__l_")
    return df.withColumn("loose", F.concat(*[F.col(f"__l_{k}") for k in LOOSE])).drop("__rest", *[f"__l_{k}" for k in LOOSE])


# ---- labelers: a span gives 1, -1 or 0

def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _form(s: Column) -> Column:
    d = _digits(s["hit"])
    ok = (F.when(s["kind"] == "card", F.call_function("luhn_check", d)).when(s["kind"] == "phone", s["hit"].startswith("+") | d.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$"))
          .when(s["kind"] == "ssn", ~d.rlike("^(?:000|666|9)") & ~d.rlike("^...00|0000$"))
          .when(s["kind"] == "ip", s["hit"].rlike(r"[:.].*[:.].*[:.]")).otherwise(F.lit(None).cast("boolean")))
    return _vote(F.coalesce(ok, F.lit(False)), F.coalesce(~ok, F.lit(False)))


def _gazetteer(s: Column) -> Column:
    tops, names = TOP_DOMAINS.replace(" ", "|"), "|".join(GIVEN_NAMES)
    in_list = (F.when(s["kind"] == "email", s["hit"].rlike(rf"(?i)[^A-Za-z](?:{tops})$"))
               .when(s["kind"] == "card", s["hit"].rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"))
               .when(s["kind"] == "name", s["hit"].rlike(rf"^(?:{names}) ")).otherwise(F.lit(None).cast("boolean")))
    return _vote(F.coalesce(in_list, F.lit(False)), F.coalesce(~in_list, F.lit(False)))


def _context(s: Column) -> Column:
    return _vote(s["before"].rlike(FOR), s["before"].rlike(AGAINST))


def _edges(s: Column) -> Column:
    stuck = s["before"].rlike(r"[\p{L}\p{N}_/=#-]$") | s["after"].rlike(r"^[\p{L}\p{N}_/=#-]")
    return _vote(~stuck, stuck)


def _variety(s: Column) -> Column:
    d = _digits(s["hit"])
    return _vote(F.lit(False), d.rlike(r"^([0-9])\1+$") | d.rlike("^0?1234567"))


LABELERS = {"form": _form, "gazetteer": _gazetteer, "context": _context, "edges": _edges, "variety": _variety}


def _voted(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
        *[f(s).alias(n) for n, f in LABELERS.items()], (s["stop"] - s["start"] > 20).alias("long")))


# ---- reliabilities and classifier (driver, on counts of vote patterns)

@dataclass(frozen=True)
class Pattern:
    kind: str
    votes: tuple[int, ...]
    long: bool
    base: bool
    n: int


@dataclass(frozen=True)
class Model:
    """``hit``/``miss``: how likely each labeler says 1 and -1 about personal
    and other spans; ``weights``: the classifier, by feature."""
    personal: dict[str, tuple[float, float]]
    other: dict[str, tuple[float, float]]
    weights: dict[str, float]


def _features(p: Pattern) -> dict[str, float]:
    out = {"bias": 1.0, f"kind={p.kind}": 1.0, "long": float(p.long)}
    for name, v in zip(LABELERS, p.votes, strict=True):
        if v:
            out[f"{name}={v}"] = 1.0
    return out


def reliabilities(patterns: Sequence[Pattern], rounds: int = 40) -> tuple[dict, dict, list[float]]:
    """Expectation-maximisation of labelers that vote independently given the
    truth, from the majority vote; base spans are known to be personal."""
    post = [1.0 if p.base else min(0.95, max(0.05, 0.5 + 0.2 * sum(p.votes))) for p in patterns]
    names = list(LABELERS)
    personal: dict[str, tuple[float, float]] = {}
    other: dict[str, tuple[float, float]] = {}
    for _ in range(rounds):
        weight = [sum(p.n * (q if side else 1 - q) for p, q in zip(patterns, post, strict=True)) for side in (0, 1)]
        prior = (weight[1] + 1) / (sum(weight) + 2)
        for side, table in ((1, personal), (0, other)):
            for k, name in enumerate(names):
                # A labeler is taken to be somewhat better than chance.
                start = (2.0, 1.0) if side else (1.0, 2.0)
                for_, against = (sum(p.n * (q if side else 1 - q) for p, q in zip(patterns, post, strict=True) if p.votes[k] == v)
                                 for v in (1, -1))
                total = weight[side] + 6
                table[name] = (for_ + start[0]) / total, (against + start[1]) / total
        new = []
        for p in patterns:
            odds = math.log(prior / (1 - prior))
            for name, v in zip(names, p.votes, strict=True):
                a, b = personal[name], other[name]
                x, y = ((a[0], b[0]) if v == 1 else (a[1], b[1]) if v == -1 else (1 - a[0] - a[1], 1 - b[0] - b[1]))
                odds += math.log(max(x, 1e-6) / max(y, 1e-6))
            new.append(1.0 if p.base else 1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        if max((abs(a - b) for a, b in zip(new, post, strict=True)), default=0.0) < 1e-6:
            break
        post = new
    return personal, other, post


def fit(patterns: Sequence[Pattern], steps: int = 400, rate: float = 0.5, decay: float = 1e-3) -> Model:
    personal, other, post = reliabilities(patterns)
    names = sorted({f for p in patterns for f in _features(p)})
    weights = dict.fromkeys(names, 0.0)
    total = sum(p.n for p in patterns) or 1
    rows = [(_features(p), q, p.n / total) for p, q in zip(patterns, post, strict=True)]
    for _ in range(steps):
        grad = dict.fromkeys(names, 0.0)
        for x, q, share in rows:
            z = sum(weights[f] * v for f, v in x.items())
            gap = share * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - q)
            for f, v in x.items():
                grad[f] += gap * v
        for f in names:
            weights[f] -= rate * (grad[f] + decay * weights[f])
    return Model(personal, other, weights)


def _pattern_counts(voted: DataFrame) -> list[Pattern]:
    """At most kinds x 3^labelers x 4 rows come to the driver."""
    each = voted.select(F.explode(F.concat(
        F.transform("base", lambda s: F.struct(F.lit(True).alias("base"), s.alias("s"))),
        F.transform("loose", lambda s: F.struct(F.lit(False).alias("base"), s.alias("s"))))).alias("x")).select("x.base", "x.s.*")
    keys = ["kind", "base", "long", *LABELERS]
    return sorted((Pattern(r.kind, tuple(r[n] for n in LABELERS), r.long, r.base, r.n)
                   for r in each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect()),
                  key=lambda p: (p.kind, p.votes, p.long, p.base))


def _accepted(s: Column, model: Model) -> Column:
    """The classifier as an expression over a voted span."""
    w = model.weights
    if not w:
        return F.lit(False)
    z = F.lit(w.get("bias", 0.0)) + F.when(s["long"], w.get("long", 0.0)).otherwise(0.0)
    for kind in KINDS:
        z = z + F.when(s["kind"] == kind, w.get(f"kind={kind}", 0.0)).otherwise(0.0)
    for name in LABELERS:
        for v in (1, -1):
            z = z + F.when(s[name] == v, w.get(f"{name}={v}", 0.0)).otherwise(0.0)
    return z >= 0


# ---- the operator

def _voted_docs(docs: DataFrame, text_col: str) -> DataFrame:
    return (_spans(docs, text_col).withColumn("base", _voted(F.col("base"))).withColumn("loose", _voted(F.col("loose"))))


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _in_order(spans: Column) -> Column:
    """By kind as listed, then start."""
    keyed = F.transform(spans, lambda s: F.struct(
        _rank(s["kind"]).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(_in_order(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def learn(docs: DataFrame, text_col: str = "text") -> Model:
    """The span classifier of a corpus."""
    text = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return fit(_pattern_counts(_voted_docs(text, "text").select("base", "loose")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of
    each row; the classifier is learned from all of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    voted = stored(_voted_docs(rows, "text").select("id", "base", "loose"), "pii-spans")
    model = fit(_pattern_counts(voted))
    added = F.filter("loose", lambda s: _accepted(s, model))
    count = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return voted.select(F.col("id").alias(id_col), *count, F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _written(F.concat("base", added)).alias("spans"), F.size(added).cast("long").alias("n_added"))


def redact(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets (spans
    that overlap become one, named after the first)."""
    model = model or learn(docs, text_col)
    plain, written = apart(docs), named_apart(docs, text_col)
    voted = _voted_docs(plain.withColumn("__text", F.coalesce(F.col(written), F.lit(""))), "__text")
    spans = F.concat("base", F.filter("loose", lambda s: _accepted(s, model)))
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    # Parts of the new text, walked once; `at` is how far the old text is copied.
    walked = F.aggregate(
        by_start, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["parts"]).otherwise(F.concat(acc["parts"], F.array(
                F.substring(F.col("__text"), acc["at"] + 1, s["start"] - acc["at"]),
                F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))).alias("parts")),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(F.col("__text"), acc["at"] + 1, F.length("__text"))))
    clean = F.when(F.size(spans) > 0, walked).otherwise(F.col(written))
    return together(voted.withColumn(written, clean), docs)
