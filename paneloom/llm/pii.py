"""Personal-data spans by weak supervision, with DataFrame and SQL functions only.

Strict patterns give the base spans, which always stay. Looser patterns give further candidates. Four labelers vote on every
candidate (1, -1 or nothing): the strict form of the value (regex), cue words and mail domains (gazetteer), the characters
around it (context) and its length and variety (shape). The distinct combinations of votes and features, counted over all
documents, are a small table of fixed largest size; on it expectation-maximisation estimates how reliable each vote is and
thereby how likely each combination is personal data, and a logistic classifier over votes and features is trained on these
likelihoods. It then decides on each candidate that is not a base span.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import save

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number", "email_like")

# Patterns. Possessive and look-behind forms find what the plain forms find, in linear time and without recursion.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"  # shorter runs of digits are dropped in any case
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SECRET = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{16,}+"
NUMBER = r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){8,18}+(?![0-9])"
EMAIL_LIKE = rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z]{{2,}}"

# Gazetteers (fixed values).
CUES = "token|key|secret|password|passwd|auth|mail|email|phone|tel|mobile|call|card|visa|account|ssn|passport|iban|contact|user|address"
NOT_CUES = "page|chapter|version|volume|section|figure|isbn|issn|release|commit|build"
DOMAINS = "example|gmail|yahoo|outlook|hotmail|proton|icloud|gmx"

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
N_VOTES, N_CELLS = 12, 12 + len(KINDS) + 4 + 3


@dataclass(frozen=True)
class Finder:
    kind: int
    pattern: str
    #: cheap test that every text with a match passes
    hint: str


FINDERS = (
    Finder(0, EMAIL, "@"),
    Finder(1, IP, r"[0-9]\.[0-9]+\.[0-9]"),
    Finder(2, CARD, r"[0-9](?:[\x20-]?[0-9]){13}"),
    Finder(3, PHONE, r"\+[0-9]"),
    Finder(4, SECRET, r"[0-9]"),
    Finder(5, NUMBER, r"[0-9](?:[\x20.-]?[0-9]){8}"),
    Finder(6, EMAIL_LIKE, r"[\[(]at[\])]"),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: int, value: Column) -> Column:
    """What a match must satisfy besides its pattern."""
    n = F.length(_digits(value))
    if kind == 1:
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == 2:
        return n.between(14, 19) & F.call_function("luhn_check", _digits(value))
    if kind == 3:
        return n.between(10, 15)
    return F.lit(True)


def _cell(labeler: int, vote: Column) -> Column:
    return (vote + F.lit(3 * labeler + 1)).cast("int")


def _cells(kind: int, value: Column, before: Column, after: Column) -> Column:
    """Indices of what holds for a candidate: a vote of each labeler, its kind, length class and share of digits."""
    n_digits, n = F.length(_digits(value)), F.length(value)
    strict = {
        4: (n_digits >= 4) & (n - n_digits >= 4) & ~value.rlike("[_-]{2}"),
        5: value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") | F.call_function("luhn_check", _digits(value)),
    }.get(kind, F.lit(True))
    window = F.lower(F.right(before, F.lit(24)))
    sane = {0: n <= 254, 4: n <= 128, 6: n <= 254}.get(kind, ~value.rlike(r"^\D*([0-9])(?:\D*\1)*$"))
    votes = (
        F.when(strict, 1).otherwise(-1),
        F.when(window.rlike(rf"(?:{CUES})\W*$") | value.rlike(rf"(?i)@?\b(?:{DOMAINS})\b"), 1).when(window.rlike(rf"(?:{NOT_CUES})\W*$"), -1).otherwise(0),
        F.when(before.rlike("[\"'=:<(]\\x20?$"), 1).when(before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"), -1).otherwise(0),
        F.when(sane, 1).otherwise(-1),
    )
    length = F.when(n < 12, 0).when(n < 20, 1).when(n < 40, 2).otherwise(3)
    share = F.when(n_digits * 10 < n * 3, 0).when(n_digits * 10 < n * 8, 1).otherwise(2)
    at = N_VOTES + len(KINDS)
    return F.array(*[_cell(j, v) for j, v in enumerate(votes)], F.lit(N_VOTES + kind), (length + at).cast("int"), (share + at + 4).cast("int"))


_SPAN = "struct<start:int,kind:int,end:int,cells:array<int>>"


def _spans(text: Column, f: Finder) -> Column:
    """array of spans of one kind: the pieces between the matches tell where these stand, in code points."""
    found, gaps = F.regexp_extract_all(text, F.lit(f.pattern), F.lit(0)), F.split(text, f.pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), gaps.alias("gaps"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def step(acc, value):
        before, after = F.get(acc["gaps"], acc["i"]), F.get(acc["gaps"], acc["i"] + 1)
        at = acc["at"] + F.length(before)
        span = F.struct(at.alias("start"), F.lit(f.kind).alias("kind"), (at + F.length(value)).alias("end"), _cells(f.kind, value, before, after).alias("cells"))
        return F.struct((at + F.length(value)).alias("at"), (acc["i"] + 1).alias("i"), acc["gaps"].alias("gaps"), F.when(_holds(f.kind, value), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    hit = F.contains(text, F.lit(f.hint)) if f.hint == "@" else text.rlike(f.hint)
    return F.when(hit, F.aggregate(found, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(f"array<{_SPAN}>"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, more): base spans, and candidates that overlap none of them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), F.concat(*[_spans(text, f) for f in FINDERS[:4]]).alias("base"), F.concat(*[_spans(text, f) for f in FINDERS[4:]]).alias("more"))
    clear = F.filter("more", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    return found.select("doc_id", F.array_sort("base").alias("base"), F.when(F.size("more") > 0, clear).otherwise(F.col("more")).alias("more"))


def _let(value: Column, then) -> Column:
    return F.get(F.transform(F.array(value), then), 0)


def _score(s: Column, cells: Column) -> Column:
    return 1 / (1 + F.exp(-F.aggregate(cells, s["b"], lambda a, c: a + F.get(s["w"], c))))


def _weighted(pats: Column, by: Column, n: int) -> Column:
    """Sums of by (one value for each combination) over the combinations that hold each cell."""
    both = F.arrays_zip(pats.alias("p"), by.alias("r"))
    zero = F.array_repeat(F.lit(0.0), n)
    return F.aggregate(both, zero, lambda acc, x: F.transform(acc, lambda v, c: v + F.when(F.array_contains(x["p"]["cells"], c), x["r"]).otherwise(0.0)))


def _em(pats: Column, rounds: int = 25) -> Column:
    """Vote reliabilities as log odds for each vote, and the prior's, by expectation-maximisation from a majority vote."""
    start = F.struct(F.lit(0.0).alias("b"), F.array(*[F.lit(float(i % 3 - 1)) for i in range(N_VOTES)]).alias("w"))

    def step(s, _):
        def update(r):
            yes = F.zip_with(pats, r, lambda p, x: p["n"] * x)
            no = F.zip_with(pats, r, lambda p, x: p["n"] * (1 - x))

            def total(a):
                return F.aggregate(a, F.lit(1.0), lambda s, x: s + x)

            odds = F.zip_with(_weighted(pats, yes, N_VOTES), _weighted(pats, no, N_VOTES), lambda y, n: F.log((y + 0.5) / (total(yes) + 1.5)) - F.log((n + 0.5) / (total(no) + 1.5)))
            return F.struct(F.log(total(yes) / total(no)).alias("b"), odds.alias("w"))

        return _let(F.transform(pats, lambda p: _score(s, F.slice(p["cells"], 1, 4))), update)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)


def _logistic(pats: Column, aims: Column, steps: int = 150, rate: float = 2.0, shrink: float = 1e-3) -> Column:
    """Classifier over all cells, fitted to the aims (a likelihood for each combination) by gradient ascent."""
    start = F.struct(F.lit(0.0).alias("b"), F.array_repeat(F.lit(0.0), N_CELLS).alias("w"))
    all_n = F.aggregate(pats, F.lit(1e-9), lambda s, p: s + p["n"])

    def step(s, _):
        off = F.zip_with(pats, aims, lambda p, a: p["n"] * (a - _score(s, p["cells"])) / all_n)
        return _let(off, lambda d: F.struct((s["b"] + rate * F.aggregate(d, F.lit(0.0), lambda t, x: t + x)).alias("b"), F.zip_with(s["w"], _weighted(pats, d, N_CELLS), lambda w, g: w + rate * (g - shrink * w)).alias("w")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def fit(found: DataFrame) -> DataFrame:
    """One row (b, w): the span classifier. At most 3^4 * 7 * 4 * 3 combinations of cells exist, whatever the input."""
    pats = found.select(F.explode(F.concat("base", "more")).alias("s")).groupBy(F.col("s.cells").alias("cells")).agg(F.count("*").cast("double").alias("n"))
    one = pats.groupBy().agg(F.array_sort(F.collect_list(F.struct("cells", "n"))).alias("pats"))
    aims = one.withColumn("em", _em(F.col("pats"))).withColumn("aims", F.transform("pats", lambda p: _score(F.col("em"), F.slice(p["cells"], 1, 4))))
    return aims.select(_logistic(F.col("pats"), F.col("aims")).alias("m")).select("m.*")


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    spans has every span as kind:start:end in code points, by start and then kind; base_sha256 is the digest of the base spans
    written likewise. A null text counts as empty and has no spans. Repeated rows, equal ids and null ids each give a row.
    Other columns are ignored; an empty table gives an empty result.
    """
    found = save(candidates(docs, id_col, text_col), "pii")
    b, w = fit(found).first()
    # rounded, so that the order of sums cannot turn a decision
    model = F.struct(F.lit(round(b, 6)).alias("b"), F.array(*[F.lit(round(x, 6)) for x in w]).alias("w"))
    added = F.filter("more", lambda s: _score(model, s["cells"]) >= least)
    out = found.withColumn("added", F.when(F.size("more") > 0, added).otherwise(F.col("more")))
    def of_kind(i: int):
        return lambda s: s["kind"] == i

    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return out.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
