"""Personal data by candidate gradient boosting, in DataFrame operations and SQL functions only.

Base rules find e-mail addresses, IP addresses, payment cards and phone numbers; their spans
always stay. Generators of high recall propose further spans, which may overlap: whatever has
an @ or an (at), sequences of digits with separators, tokens that begin with a digit. Boosted
trees judge each candidate by its format and what stands before it.

The trees are to find what the rules miss, so they don't learn from what rules see. They are
fitted on all of the corpus: all different values that base rules found, respelled so that no rule
meets them ((at) for @, national forms of numbers, other groups), are personal data. Not personal data are candidates that no base span meets and that show why:
long numbers that fail the cards' checksum, words of letters and digits and pieces of them,
numbers too short to be of a person, and dates, sums and versions made from the corpus's digits. Other candidates may be
either and are left out. Candidates with the same features are one row that counts for all of them,
and both labels weigh the same. The threshold is one that finds ``RECALL`` of the respelled values of
a held-out part, and lies above all but ``FALSE`` of the others if it may. What reaches it and
meets no base span is added with kind ``likely``, by score from the highest, unless it meets
one added before it; spans that overlap in a chain are settled among themselves, so a text with
many spans takes time in proportion, and one long chain the square of its spans.

Matches come from a text's pieces: what lies between matches, and the matches, add up to
where each begins. The trees are written out as CASE expressions over an array of features,
so a document is scanned where it is read: no rows are exploded, nothing is shuffled.

Offsets are code points, ends exclusive. Patterns use possessive repeats, which neither
backtrack nor recurse, so a text's length doesn't matter to them. Defined cases: a null or
empty text has no spans; rows with equal ids are scanned each on its own; where the corpus
lacks one of the labels, nothing is added to the base spans. Other columns stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.order import nth_highest
from clickloom.session import ensure_checkpoints

KINDS = ("email", "ip", "card", "phone")
LIKELY = "likely"
RECALL = 0.98
FALSE = 0.002
SPELLINGS = 3
TREES = 16
DEPTH = 3
BEFORE, AFTER = 24, 12

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "A-Za-z0-9-"
#: Each base rule finds its matches from left to right. \G takes up where the last match ended, the
#: lookbehind begins at the first character of a run: a run is read once, whatever its length. The
#: lookahead before it passes over most characters at one glance.
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++(?:\.[{_LABEL}]++)++"
IP = r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A chain of digits with single separators is maximal; only chains of 14 to 19 digits can count.
CARD = r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

GENERATORS = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++(?:@|\x20?[(\[]at[)\]]\x20?)[^\s@]++",
    r"\+?\(?[0-9](?:[().\x20-]{0,2}+[0-9]){6,}+",
    r"(?=[0-9])(?<![0-9A-Za-z])[0-9][^\s@,;]{2,}+",
)
#: What a text must hold for a generator to find anything in it.
GENERATOR_HOLDS = (("@", "(at)", "[at]"), "", "")
WORDS = ("tel", "phone", "call", "fax", "mail", "contact", "card", "visa", "account", "ssn", "ip", "address", "host")

SPANS = "array<struct<start: int, rank: int, end: int, kind: string, score: double>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's sum."""

    def place(sum_, i):
        digit = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return sum_ + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), place) % 10 == 0


def _is_ip(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), _byte)


def _byte(part: Column) -> Column:
    plain = F.ltrim(part, F.lit("0"))
    return (F.char_length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)


def _is_card(match: Column) -> Column:
    return _luhn(_digits(match))


def _is_phone(match: Column) -> Column:
    return F.char_length(_digits(match)).between(10, 15)


RULES: dict[str, tuple[str | tuple[str, ...], str, Callable[[Column], Column] | None]] = {
    "email": (("@",), EMAIL, None),
    "ip": (r"[0-9]\.[0-9]", IP, _is_ip),
    "card": ("", CARD, _is_card),
    "phone": (r"\+[0-9]", PHONE, _is_phone),
}

_MARK = "\x01"
_FOUND = "array<struct<start: int, end: int, match: string, before: string>>"
#: Prefix sums and maxima are taken within runs of so many elements, and over the runs.
_RUN = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, x: total + x)


def _runs(numbers: Column, whole: Callable[[Column], Column]) -> Column:
    """For each run of the numbers, ``whole`` of all runs before it (null before the first)."""
    last = ((F.size(numbers) - 1) / _RUN).cast("int")
    each = F.transform(F.sequence(F.lit(0), last), lambda r: whole(F.slice(numbers, r * _RUN + 1, _RUN)))
    return _let(each, lambda e: F.transform(F.sequence(F.lit(0), last), lambda r: whole(F.slice(e, F.lit(1), r))))


def _run_of(at: Column) -> Column:
    return F.floor(at / _RUN).cast("int")


def _worth(text: Column, holds: str | tuple[str, ...]) -> Column:
    if isinstance(holds, tuple):
        return reduce(Column.__or__, (text.contains(h) for h in holds))
    return F.rlike(text, F.lit(holds)) if holds else text.isNotNull()


def matches(text: Column, pattern: str, holds: str | tuple[str, ...] = "") -> Column:
    """``start, end, match, before`` of each match.

    Texts without a match of ``holds``, or without any of its strings, are not searched.

    One search puts marks around the matches, so that every second part of the text is one.
    A text that holds the mark itself is searched twice, for the matches and what lies between.
    """
    marked = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}")), _MARK, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    apart = F.flatten(F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("piece"), found.alias("match")), _pair))
    parts = F.when(text.contains(_MARK), F.array_compact(apart)).otherwise(marked)
    none = F.array().cast(_FOUND)
    return F.when(_worth(text, holds), _let(parts, _located)).otherwise(none)


def _located(parts: Column) -> Column:
    """Every second part with its place, from the lengths of the parts before it."""
    none = F.array().cast(_FOUND)

    def placed(lengths: Column, before: Column) -> Column:
        def one(k: Column) -> Column:
            at = 2 * k + 1
            run = _run_of(at)
            start = F.get(before, run) + _sum(F.slice(lengths, run * _RUN + 1, at % _RUN))
            return F.struct(
                start.alias("start"),
                (start + F.get(lengths, at)).alias("end"),
                F.get(parts, at).alias("match"),
                F.right(F.get(parts, at - 1), F.lit(BEFORE)).alias("before"),
            )

        return F.transform(F.sequence(F.lit(0), ((F.size(parts) - 3) / 2).cast("int")), one)

    sizes = F.transform(parts, F.char_length)
    located = _let(sizes, lambda lengths: _let(_runs(lengths, _sum), lambda before: placed(lengths, before)))
    return F.when(F.size(parts) > 1, located).otherwise(none)


def _pair(x: Column) -> Column:
    return F.array(x.piece, x.match)


def base_spans(text: Column, with_match: bool = False) -> Column:
    """Spans of the base rules as ``SPANS``, in order; on request with fields ``match`` and ``before`` too."""
    each = []
    for rank, (kind, (holds, pattern, check)) in enumerate(RULES.items()):
        found = matches(text, pattern, holds)
        if check is not None:
            found = F.filter(found, _checked(check))
        each.append(F.transform(found, _spanned(rank, kind, with_match)))
    return F.array_sort(F.concat(*each))


def _checked(check: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda m: check(m.match)


def _spanned(rank: int, kind: str, with_match: bool) -> Callable[[Column], Column]:
    more = lambda m: [m.match.alias("match"), m.before.alias("before")] if with_match else []
    return lambda m: _span(m, rank, kind, F.lit(1.0), *more(m))


def _span(m: Column, rank: int, kind: str, score: Column, *more: Column) -> Column:
    return F.struct(
        m.start.alias("start"), F.lit(rank).alias("rank"), m.end.alias("end"), F.lit(kind).alias("kind"), score.alias("score"), *more
    )


def _count(text: Column, characters: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{characters}]", "")).cast("double")


_DATE = r"^(?:(?:19|20)[0-9]{2}[-./\x20][01]?[0-9]|[0-3]?[0-9][-./][01]?[0-9][-./](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-(?:19|20)[0-9]{2})"


def _features(m: Column) -> Column:
    """Format and surroundings of a candidate, as an array of doubles."""
    low = F.lower(m.before)
    digits = _digits(m.match)
    format_ = [
        F.char_length(m.match).cast("double"),
        F.char_length(digits).cast("double"),
        _count(m.match, "A-Za-z"),
        _count(m.match, "."),
        _count(m.match, "@"),
        _count(m.match, " ()-"),
        F.startswith(m.match, F.lit("+")).cast("double"),
        F.rlike(m.match, F.lit(r"^[^@]+@[A-Za-z0-9-]+\.[A-Za-z]{2}")).cast("double"),
        F.rlike(m.match, F.lit(r"^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.[0-9]{1,3}){3}$")).cast("double"),
        (F.char_length(digits).between(13, 19) & _luhn(F.right(digits, F.lit(19)))).cast("double"),
        F.rlike(m.match, F.lit(r"[A-Za-z0-9]\x20?[(\[]at[)\]]\x20?[A-Za-z0-9]")).cast("double"),
        F.rlike(m.match, F.lit(r"^[0-9]{1,3}\[\.\][0-9]{1,3}\[\.\][0-9]")).cast("double"),
        F.rlike(m.match, F.lit(_DATE)).cast("double"),
        F.rlike(m.match, F.lit(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}\b")).cast("double"),
        F.char_length(F.regexp_replace(m.match, "[A-Za-z0-9(). @-]", "")).cast("double"),
    ]
    context = [
        F.rlike(low, F.lit(r"[\s,;:(\"'=]$|^$")).cast("double"),
        F.rlike(low, F.lit(r"[0-9.+-]$")).cast("double"),
        F.rlike(low, F.lit("[a-z]$")).cast("double"),
        F.rlike(low, F.lit("|".join(WORDS))).cast("double"),
        F.rlike(low, F.lit(r"[=:]\s*[\"']?$")).cast("double"),
    ]
    return F.array(*format_, *context)


def candidates(text: Column) -> Column:
    """``start, end, features`` of what the generators propose; they may overlap."""
    each = [matches(text, pattern, holds) for pattern, holds in zip(GENERATORS, GENERATOR_HOLDS)]
    return F.transform(
        F.concat(*each),
        lambda m: F.struct(m.start.alias("start"), m.end.alias("end"), _features(m).alias("features"), _told(m).alias("other")),
    )


def _told(m: Column) -> Column:
    """Whether a candidate that no base span meets shows that it is no personal data."""
    digits = F.char_length(_digits(m.match))
    alone = F.rlike(m.match, F.lit(r"^[0-9][0-9\x20-]*+[^0-9A-Za-z]*+$"))
    sums = alone & ((digits > 19) | (digits.between(14, 19) & ~_luhn(F.right(_digits(m.match), F.lit(19)))))
    inside = F.rlike(m.before, F.lit("[A-Za-z0-9]$"))
    address = F.rlike(m.match, F.lit(r"@|[(\[]at[)\]]"))
    mixed = F.rlike(m.match, F.lit("^[0-9]+[A-Za-z]")) & (digits >= 7)
    return sums | inside | (~address & (mixed | (digits < 7)))


def _once(**columns: Column) -> Column:
    """The columns as one generated row. A generator is not merged with what reads its columns, so
    lambdas get values and don't search the text again for each candidate."""
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))


def _reached(ends: Column) -> Column:
    """How far the spans up to each one reach."""

    def reached(values: Column, before: Column) -> Column:
        def one(at: Column) -> Column:
            run = _run_of(at)
            return F.greatest(F.get(before, run), F.array_max(F.slice(values, run * _RUN + 1, at % _RUN + 1)))

        return F.transform(F.sequence(F.lit(0), F.size(values) - 1), one)

    some = _let(ends, lambda values: _let(_runs(values, F.array_max), lambda before: reached(values, before)))
    return F.when(F.size(ends) > 0, some).otherwise(F.array().cast("array<int>"))


def _with_reach(proposed: DataFrame) -> DataFrame:
    """Adds ``starts`` of the base spans and ``reach``, how far the spans up to each one reach."""
    return proposed.select("*", _once(starts=F.col("base.start"), reach=_reached(F.col("base.end"))))


def _meets_base(span: Column) -> Column:
    """Whether a base span overlaps: of those that start before the span's end, the farthest passes its start."""
    powers = F.array(*[F.lit(1 << k) for k in reversed(range(31))])
    earlier = F.aggregate(
        powers,
        F.lit(0).cast("bigint"),
        lambda n, power: F.when(F.get("starts", (n + power - 1).cast("int")) < span.end, n + power).otherwise(n),
    )
    return (earlier > 0) & F.coalesce(F.get("reach", (earlier - 1).cast("int")) > span.start, F.lit(False))


# Trees


def _tree_of(text: str) -> list:
    """A printed tree as nested [feature, threshold, left, right], or a number."""
    lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]

    def read(at: int):
        leaf = re.match(r"Predict: (\S+)", lines[at])
        if leaf:
            return float(leaf[1]), at + 1
        test = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        left, at = read(at + 1)
        right, at = read(at + 1)  # after the line that begins with Else
        return [int(test[1]), float(test[2]), left, right], at

    return read(0)[0]


def _case(tree, features: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, left, right = tree
    return F.when(F.get(features, F.lit(feature)) <= threshold, _case(left, features)).otherwise(_case(right, features))


@dataclass(frozen=True)
class Boosted:
    trees: list
    weights: list[float]
    threshold: float

    def score(self, features: Column) -> Column:
        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            total = total + F.lit(weight) * _case(tree, features)
        return 1 / (1 + F.exp(-2 * total))


def _written(model: GBTClassificationModel) -> tuple[list, list[float]]:
    return [_tree_of(t.toDebugString) for t in model.trees], list(model.treeWeights)


def threshold_of(scored: list[tuple[float, int]], recall: float, false: float = FALSE) -> float:
    """The highest score that finds the share ``recall`` of label 1, or, if lower, the first above all but ``false`` of label 0."""
    by_label = {k: sorted((x for x, label in scored if label == k), reverse=True) for k in (1, 0)}
    return _threshold({k: len(own) for k, own in by_label.items()}, lambda k, n: by_label[k][n - 1], recall, false)


def _threshold(counts: dict[int, int], nth: Callable[[int, int], float], recall: float, false: float = FALSE) -> float:
    """From how many there are of each label, and the n-th highest score of a label."""
    yes, no = counts.get(1, 0), counts.get(0, 0)
    finds = nth(1, max(1, math.ceil(recall * yes))) if yes else 1.1
    spares = math.nextafter(nth(0, int(false * no) + 1), 2) if no else 1.1
    return min(finds, spares)


# What is said before personal data.
LEADS = ("tel ", "call ", "fax: ", "mail ", "contact ", "card ", "ssn ", "id ", "host ", "", "", "", "")


def _chosen(options: list, seed: Column) -> Column:
    """One of the options, by a number."""
    return F.get(F.array(*[F.lit(o) if isinstance(o, str) else o for o in options]), F.pmod(seed, F.lit(len(options))).cast("int"))


def _cut(text: Column, *sizes: int) -> list[Column]:
    """Pieces of a text, one after another."""
    starts = [1 + sum(sizes[:k]) for k in range(len(sizes))]
    return [F.substring(text, a, n) for a, n in zip(starts, sizes)]


def respelled(kind: Column, match: Column, seed: Column) -> Column:
    """A base match in a form that no base rule asks for, chosen by a number."""
    digits = _digits(match)
    national, short = F.right(digits, F.lit(10)), F.right(digits, F.lit(9))
    a, b, c = _cut(national, 3, 3, 4)
    phones = [
        F.concat(F.lit("("), a, F.lit(") "), b, F.lit("-"), c),
        F.concat_ws("-", a, b, c),
        F.concat(F.lit("0"), a, F.lit(" "), b, c),
        F.concat_ws(".", a, b, c),
        F.concat_ws(" ", a, b, c),
        F.concat_ws("-", *_cut(short, 3, 2, 4)),
        F.concat(F.lit("00"), digits),
    ]
    cards = [F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{sep}") for sep in (".", "  ", "--")]
    mails = [F.replace(match, F.lit("@"), F.lit(at)) for at in (" (at) ", "(at)", "[at]", " [at] ")]
    return (
        F.when(kind == "phone", _chosen(phones, seed))
        .when(kind == "card", _chosen(cards, seed))
        .when(kind == "email", _chosen(mails, seed))
        .otherwise(F.replace(match, F.lit("."), F.lit("[.]")))
    )


def ordinary(seed: Column) -> Column:
    """A date, a sum or a version from a number."""

    def digits(k: int, low: int, high: int, width: int) -> Column:
        return F.lpad((F.pmod(F.xxhash64(seed, F.lit(k)), F.lit(high - low)) + low).cast("string"), width, "0")

    year, month, day, hour = digits(1, 1950, 2040, 4), digits(2, 1, 13, 2), digits(3, 1, 29, 2), digits(4, 0, 24, 2)
    forms = [
        F.concat_ws("-", year, month, day),
        F.concat_ws(".", day, month, year),
        F.concat_ws("/", year, month, day),
        F.concat(F.concat_ws("-", year, month, day), F.lit(" "), hour),
        F.concat_ws("-", year, digits(5, 1950, 2040, 4)),
        F.concat_ws(",", digits(6, 1, 999, 1), digits(7, 0, 1000, 3), digits(8, 0, 1000, 3)),
        F.concat_ws(".", digits(9, 1, 30, 1), digits(10, 0, 30, 1), digits(11, 256, 9999, 1), digits(12, 0, 99999, 1)),
        F.concat(digits(13, 1, 10**7, 7), F.lit("."), hour),
    ]
    return _chosen(forms, F.xxhash64(seed, F.lit(0)))


def _shown(matched: DataFrame) -> DataFrame:
    """``text, start, end, label, order``: respelled values and ordinary numbers, each in a text of its own."""
    rows = matched.select("*", F.explode(F.sequence(F.lit(0), F.lit(SPELLINGS - 1))).alias("k"))
    rows = rows.select("*", F.xxhash64("match", "before", "k").alias("seed"), F.explode(F.array(F.lit(1), F.lit(0))).alias("label"))
    value = F.when(F.col("label") == 1, respelled(F.col("kind"), F.col("match"), F.col("seed"))).otherwise(ordinary(F.col("seed")))
    ahead = F.concat(F.regexp_replace(F.right("before", F.lit(12)), "[^a-zA-Z ]", " "), F.lit(" "), _chosen(list(LEADS), F.xxhash64("seed")))
    rows = rows.select(value.alias("value"), ahead.alias("ahead"), "label", F.xxhash64("match", "before").alias("order"))
    start = F.char_length("ahead")
    text = F.concat("ahead", "value", F.lit(" and then"))
    return rows.select(text.alias("text"), start.alias("start"), (start + F.char_length("value")).alias("end"), "label", "order")


def _alike(rows: DataFrame) -> DataFrame:
    """``features, label, n, held``: candidates with the same features and label, of which ``n`` are held out, or not.

    ``rows`` has ``n`` alike ones each. A quarter of those without an ``order`` is held out, and of others the ones that it says.
    """
    ordered = F.col("order").isNotNull()
    rest = (F.pmod(F.xxhash64("features"), F.lit(4)) < F.col("n") % 4).cast("bigint")
    out = F.when(ordered, F.when(F.pmod("order", F.lit(4)) == 0, F.col("n")).otherwise(0)).otherwise(F.floor(F.col("n") / 4) + rest)
    split = rows.select("features", "label", "n", out.alias("out"))
    sides = F.array(*[F.struct(F.lit(k).alias("held"), n.alias("n")) for k, n in ((True, F.col("out")), (False, F.col("n") - F.col("out")))])
    return split.select("features", "label", F.inline(sides)).filter("n > 0").groupBy("features", "label", "held").agg(F.sum("n").alias("n"))


def train_personal_data(documents: DataFrame, text: str = "text", recall: float = RECALL) -> Boosted | None:
    """Fit on all candidates of either label; a quarter of them is held out."""
    ensure_checkpoints(documents.sparkSession)
    found, all_of = candidates(F.col(text)), base_spans(F.col(text), with_match=True)
    marked = _with_reach(documents.select(_once(base=all_of, found=found)))
    others = F.transform(F.filter("found", lambda c: c.other & ~_meets_base(c)), lambda c: c.features)
    both = marked.select("base", _once(others=others)).checkpoint()
    matched = both.select(F.inline("base")).select("kind", "match", "before").distinct()
    shown = _shown(matched)
    proposed = _with_reach(shown.select("*", _once(base=base_spans(F.col("text")), found=candidates(F.col("text")))))
    covers = lambda c: 5 * (F.least(c.end, F.col("end")) - F.greatest(c.start, F.col("start"))) >= 3 * (F.col("end") - F.col("start"))
    free = F.filter("found", lambda c: covers(c) & ~_meets_base(c))
    made = proposed.select("label", "order", F.explode(F.transform(free, lambda c: c.features)).alias("features"))
    told = both.select(F.explode("others").alias("features")).groupBy("features").agg(F.count("*").alias("n"))
    told = told.select(F.lit(0).alias("label"), F.lit(None).cast("bigint").alias("order"), "features", "n")
    sample = _alike(made.withColumn("n", F.lit(1).cast("bigint")).unionByName(told)).sortWithinPartitions("label", "features", "held").checkpoint()
    totals = {(r["held"], r["label"]): r["n"] for r in sample.groupBy("held", "label").agg(F.sum("n").alias("n")).collect()}
    yes, no = totals.get((False, 1), 0), totals.get((False, 0), 0)
    if not (yes and no):
        return None
    weight = F.col("n") * F.when(F.col("label") == 1, 1.0).otherwise(yes / no)
    seen = sample.filter(~F.col("held")).select(array_to_vector("features").alias("features"), F.col("label").cast("double"), weight.alias("weight"))
    fit = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32, weightCol="weight").fit(seen)
    trees, weights = _written(fit)
    raw = Boosted(trees, weights, 1.0)
    scored = sample.filter("held").select(raw.score(F.col("features")).alias("score"), "label", "n").checkpoint()
    nth = lambda label, n: nth_highest(scored.filter(F.col("label") == label), "score", "n", n)
    return Boosted(trees, weights, _threshold({k: totals.get((True, k), 0) for k in (1, 0)}, nth, recall))


def personal_spans(documents: DataFrame, model: Boosted | None, text: str = "text", name: str = "spans") -> DataFrame:
    """The documents, struct ``row``, with base spans and those the trees add, by start, as a column of type ``SPANS``."""
    rows = documents.select(F.struct("*").alias("row"), documents[text].alias("text"))
    if model is None:
        return rows.select("row", base_spans(F.col("text")).alias(name))
    proposed = _with_reach(rows.select("row", _once(base=base_spans(F.col("text")), found=candidates(F.col("text")))))
    free = proposed.select("row", "base", F.filter("found", lambda c: ~_meets_base(c)).alias("free"))
    scored = free.select(
        "row",
        "base",
        _once(chosen=F.filter(F.transform("free", lambda c: _span(c, len(KINDS), LIKELY, model.score(c.features))), lambda s: s.score >= model.threshold)),
    )
    return scored.select("row", F.array_sort(F.concat("base", _apart(F.col("chosen")))).alias(name))


def _apart(spans: Column) -> Column:
    """Of the spans by score, length and place, each that meets none kept before it: chain by chain of those that overlap."""

    def chains(ordered: Column, reach: Column) -> Column:
        def begins(at: Column) -> Column:
            return (at == 0) | (F.get(ordered, at).start >= F.get(reach, at - 1))

        def settled(first: Column) -> Column:
            def chain(k: Column) -> Column:
                start = F.get(first, k)
                return _best_first(F.slice(ordered, start + 1, F.coalesce(F.get(first, k + 1), F.size(ordered)) - start))

            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(first) - 1), chain))

        return _let(F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), begins), settled)

    def some(ordered: Column) -> Column:
        return _let(_reached(ordered.end), lambda reach: chains(ordered, reach))

    return F.when(F.size(spans) > 0, _let(F.array_sort(spans), some)).otherwise(F.array().cast(SPANS))


def _best_first(spans: Column) -> Column:
    ranked = F.transform(
        spans, lambda s: F.struct(s.score.alias("score"), (s.end - s.start).alias("size"), (-s.start).alias("at"), s.alias("span"))
    )

    def taken(kept: Column, r: Column) -> Column:
        met = F.exists(kept, lambda k: (k.start < r.span.end) & (r.span.start < k.end))
        return F.when(met, kept).otherwise(F.concat(kept, F.array(r.span))).cast(SPANS)

    return F.aggregate(F.sort_array(ranked, asc=False), F.array().cast(SPANS), taken)


def personal_data(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its id and the ``spans``."""
    model = train_personal_data(documents, text, **options)
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return personal_spans(own, model).select("row.doc_id", "spans")
