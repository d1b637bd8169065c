"""Personal data by weak supervision.

Four kinds are found by fixed patterns and always stay. Further candidates are secrets,
national ids, phones without a country code and spelled-out addresses, found by their shape,
and persons, postal addresses and account numbers, found through a gazetteer: a listed given
name before a capitalised one, a house number and a listed kind of street, a listed country
code. Simple labelers vote on each: strict shapes, the gazetteer, lists of words before the
candidate, the character before it, placeholder values, variety of characters. Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is and how likely each pattern is a hit; these
probabilities train a naive-Bayes classifier on features of the span, whose verdict adds
the span.

Everything on the texts is built-in functions. The driver sees counts of (kind, votes,
features) alone, at most KINDS * 3 ** LABELERS * 2 ** FEATURES rows.

Cases: a null or empty text has no spans; repeated rows are treated each; candidates that
overlap a span of the fixed kinds are left out; a corpus without candidates adds none;
other columns are ignored (``redact`` keeps them, whatever their names); an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm.common import bind, table

#: Kinds of the contract in its order, then those that the method adds.
KINDS = (
    "email", "ip", "card", "phone",
    "secret", "national_id", "local_phone", "spelled_email", "person", "address", "account",
)
N_BASE = 4

# A run of the first class is entered at its start or after the last match only, and loops
# give nothing back: time grows with the text, however long its runs are.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Fixed values of the gazetteer: given names, kinds of street, country codes of account numbers.
GIVEN_NAMES = (
    "Alice", "Ana", "Anna", "Antonio", "Carlos", "Carmen", "Charles", "Christine", "Claire", "Daniel", "David",
    "Elena", "Elizabeth", "Emma", "Franz", "George", "Hans", "Heinrich", "Isabelle", "James", "Javier", "Jean",
    "Jennifer", "John", "Jorge", "Juan", "Julia", "Karl", "Laura", "Linda", "Luis", "Manuel", "Maria", "Marie",
    "Martin", "Mary", "Michael", "Michel", "Monika", "Nathalie", "Nicolas", "Patricia", "Paul", "Peter", "Pierre",
    "Robert", "Sabine", "Sarah", "Sophie", "Stefan", "Susan", "Thomas", "Ursula", "William", "Wolfgang",
)
STREETS = ("Street", "St.", "Avenue", "Ave.", "Road", "Rd.", "Lane", "Drive", "Boulevard", "Square", "Court", "Place")
COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")


def _any_of(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(re.escape(w) for w in words) + ")"


def _listed_by_initial(words: tuple[str, ...]) -> str:
    """One of ``words``; by its first letter most places are passed at once."""
    initials = sorted({w[0] for w in words})
    rest = [f"{i}{_any_of(tuple(w[1:] for w in words if w[0] == i))}" for i in initials]
    return f"(?=[{''.join(initials)}])(?:{'|'.join(rest)})"


_NAME = _listed_by_initial(GIVEN_NAMES)
_PERSON = rf"{_NAME}(?:\x20[A-Z]\.)?\x20[A-Z][a-z]++(?:-[A-Z][a-z]++)*+"
_ADDRESS = rf"[0-9]{{1,5}}\x20[A-Z][a-z]++(?:\x20[A-Z][a-z]++)?\x20{_any_of(STREETS)}"
_ACCOUNT = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?"

#: One pattern for all candidates; which kind one is, is read from it afterwards. Runs are open
#: and possessive: a value is found to its end, however long it is.
CANDIDATE = (
    r"(?<![A-Za-z0-9_])(?i:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\x20{0,3}[=:]\x20{0,3}"
    r"[\x22']?[A-Za-z0-9_./+=-]{8,}+[\x22']?"
    r"|(?<![A-Za-z0-9])[A-Z]{4}[A-Z0-9]{16}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])"
    r"|(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
    r"|(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])"
    r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
    r"(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++"
    rf"|(?<![A-Za-z]){_PERSON}(?![A-Za-z])"
    rf"|(?<![A-Za-z0-9]){_ADDRESS}(?![A-Za-z])"
    rf"|(?<![A-Za-z0-9]){_ACCOUNT}(?![A-Za-z0-9])"
)
#: Words that announce personal data, and values that stand for none.
ANNOUNCED = r"(?i)(?:password|passwd|pwd|token|secret|key|login|ssn|social|passport|phone|tel|call|fax|mobile|mail|contact|write|reach|name|signed|address|iban|account)[^A-Za-z]{0,12}$"
PLACEHOLDER = r"(?i)(?:x{4}|0{5}|12345678|changeme|placeholder|yourpass|000-00|999-99|name\x20?[\[(]at)"
CONTEXT = 40

LABELERS = ("shape", "gazetteer", "announced", "glued", "placeholder", "variety")
FEATURES = ("digits", "upper", "lower", "assigned", "long", "varied")
ROUNDS = 50


@dataclass(frozen=True)
class SpanModel:
    """Log odds of each kind and weights of its features when set and when not."""

    prior: dict[str, float]
    weights: dict[str, list[tuple[float, float]]]
    reliability: dict[str, list[tuple[float, float]]]


def _running_sum(values: Column) -> Column:
    """Inclusive sums of an array of ints; in blocks of 64, so that long arrays stay cheap."""
    add = lambda total, x: total + x
    part = lambda start, n: F.aggregate(F.slice(values, start, n), F.lit(0), add)
    sums = F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size(values) - 1, 6)), lambda b: part(b * 64 + 1, F.lit(64))
    )
    before = F.aggregate(
        sums, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))
    )
    return bind(
        before,
        lambda b: F.transform(
            values,
            lambda _, i: F.get(b, F.shiftright(i, 6)) + part(F.shiftright(i, 6) * 64 + 1, i.bitwiseAND(63) + 1),
        ),
    )


_SPANS = "array<struct<s:int,kind:int,e:int,m:string>>"


def _matches(text: Column, pattern: str, kind: Column, worth: Column) -> Column:
    """All matches as (s, kind, e, m), in code points; what lies between gives their places."""

    def placed(found: Column, between: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.length(F.get(between, i)) + F.length(m))
        ends = bind(steps, _running_sum)
        return F.zip_with(
            ends,
            found,
            lambda e, m: F.struct((e - F.length(m)).alias("s"), kind.alias("kind"), e.alias("e"), m.alias("m")),
        )

    none = F.array().cast(_SPANS)
    found = F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return bind(
        F.coalesce(found, F.array().cast("array<string>")),
        lambda ms: F.when(F.size(ms) == 0, none).otherwise(
            bind(F.split(text, pattern, -1), lambda between: placed(ms, between)).cast(_SPANS)
        ),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": lambda m: bind(
        _digits(m), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False))
    ),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}
_WORTH = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def base_spans(text: Column) -> Column:
    """Spans of the fixed kinds, by start and then by kind."""
    has_digit = text.rlike("[0-9]")
    kinds = []
    for k, name in enumerate(KINDS[:N_BASE]):
        worth = text.contains(_WORTH[name]) if _WORTH[name] else has_digit
        worth = worth & has_digit if name != "email" else worth
        every = _matches(text, PATTERNS[name], F.lit(k), worth)
        valid = _VALID[name]
        kinds.append(F.filter(every, lambda x: valid(x["m"])))
    return F.sort_array(F.concat(*kinds))


def _kind_of(m: Column) -> Column:
    kind = (
        F.when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "national_id")
        .when(m.rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}$"), "local_phone")
        .when(m.rlike(r"[\[(]at[\])]"), "spelled_email")
        .when(m.rlike(rf"^{_PERSON}$"), "person")
        .when(m.rlike(rf"^{_ADDRESS}$"), "address")
        .when(m.rlike(rf"^{_ACCOUNT}$"), "account")
    )
    return kind.otherwise("secret")


def _votes(kind: Column, m: Column, before: Column) -> list[Column]:
    """Votes of LABELERS: 1 for personal data, -1 against, 0 for neither."""
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    strict = (
        ((kind == "secret") & m.rlike(r"^AKIA|[=:]|^[0-9a-f]{32}$|^[0-9a-f]{40}$|^[0-9a-f]{64}$"))
        | ((kind == "national_id") & ~m.rlike(r"^(?:000|666|9)|-00-|-0000$"))
        | ((kind == "local_phone") & m.rlike(r"^\(?[2-9]"))
        | kind.isin("spelled_email", "person", "address")
        | ((kind == "account") & (F.length(_digits(m)) >= 10))
    )
    listed = (
        m.rlike(rf"^{_NAME}\x20")
        | m.rlike(rf"\x20{_any_of(STREETS)}$")
        | m.rlike(rf"^{_any_of(COUNTRIES)}[0-9]{{2}}")
    )
    by_list = kind.isin("person", "address", "account")
    kinds = F.size(F.array_distinct(F.split(m, "")))
    return [
        vote(strict, ~strict),
        vote(by_list & listed, by_list & ~listed),
        vote(before.rlike(ANNOUNCED) | m.rlike(r"^[A-Za-z_-]+\x20*[=:]"), F.lit(False)),
        vote(F.lit(False), before.rlike(r"[A-Za-z0-9]$")),
        vote(F.lit(False), m.rlike(PLACEHOLDER)),
        vote(kinds >= 6, kinds <= 3),
    ]


def _features(m: Column) -> list[Column]:
    return [
        m.rlike("[0-9]"),
        m.rlike("[A-Z]"),
        m.rlike("[a-z]"),
        m.rlike("[=:]"),
        F.length(m) >= 20,
        F.size(F.array_distinct(F.split(m, ""))) >= 10,
    ]


def _coded(kind_of: Column, m: Column, before: Column) -> tuple[Column, Column]:
    """Votes as a number in base 3 and features as bits."""
    votes = F.lit(0)
    for k, v in enumerate(_votes(kind_of, m, before)):
        votes = votes + (v + 1) * 3**k
    bits = F.lit(0)
    for k, f in enumerate(_features(m)):
        bits = bits + f.cast("int") * (1 << k)
    return votes.cast("int"), bits.cast("int")


def candidates(text: Column, base: Column) -> Column:
    """Candidates (s, kind, e, votes, features) that overlap no span in ``base``."""
    worth = text.rlike(rf"[0-9]{{3}}|[\[(]at[\])]|[=:]|[A-Z]{{4}}|[0-9]\x20[A-Z]|{_NAME}\x20[A-Z]")
    every = _matches(text, CANDIDATE, F.lit(-1), worth)
    alone = F.filter(
        every, lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    )

    def judged(x: Column) -> Column:
        kind = _kind_of(x["m"])
        start = F.greatest(x["s"] - CONTEXT, F.lit(0))
        votes, bits = _coded(kind, x["m"], F.substr(text, start + 1, x["s"] - start))
        number = F.lit(len(KINDS))
        for k in range(N_BASE, len(KINDS)):
            number = F.when(kind == KINDS[k], k).otherwise(number)
        return F.struct(
            x["s"].alias("s"), number.cast("int").alias("kind"), x["e"].alias("e"),
            votes.alias("votes"), bits.alias("features"),
        )

    return F.transform(alone, judged)


def _with_spans(docs: DataFrame, columns: list[str]) -> DataFrame:
    """(row, text, base, extra): ``columns`` as one struct, so that no name clashes."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    based = docs.select(row.alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn(
        "base", base_spans(F.col("text"))
    )
    return based.withColumn("extra", candidates(F.col("text"), F.col("base")))


def _digits3(code: int) -> list[int]:
    return [code // 3**k % 3 for k in range(len(LABELERS))]


def fit_votes(counts: dict[int, int]) -> tuple[dict[int, float], list[tuple[float, float]]]:
    """Chance of a hit for each vote pattern, and each labeler's reliability (if hit, if not).

    Expectation-maximisation of a mixture of two classes in which labelers vote independently.
    It starts from labelers that are right four times in five.
    """
    theta = [[[0.1, 0.1, 0.8], [0.8, 0.1, 0.1]] for _ in LABELERS]
    prior, chance = 0.5, {}
    total = sum(counts.values())
    for _ in range(ROUNDS):
        for code in counts:
            yes, no = math.log(prior), math.log(1 - prior)
            for k, v in enumerate(_digits3(code)):
                yes += math.log(theta[k][0][v])
                no += math.log(theta[k][1][v])
            chance[code] = 1 / (1 + math.exp(min(700.0, no - yes)))
        hits = sum(n * chance[c] for c, n in counts.items())
        prior = (hits + 1) / (total + 2)
        for k in range(len(LABELERS)):
            for side, of in ((0, lambda c: chance[c]), (1, lambda c: 1 - chance[c])):
                start = [0.5, 0.5, 4.0] if side == 0 else [4.0, 0.5, 0.5]
                for code, n in counts.items():
                    start[_digits3(code)[k]] += n * of(code)
                theta[k][side] = [x / sum(start) for x in start]
    return chance, [(t[0][2], t[1][0]) for t in theta]


def train(docs: DataFrame) -> SpanModel:
    """The model of all candidates in ``docs``."""
    rows = (
        _with_spans(docs, ["text"])
        .select(F.explode("extra").alias("c"))
        .groupBy("c.kind", "c.votes", "c.features")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    prior, weights, reliability = {}, {}, {}
    for k, name in enumerate(KINDS):
        own = [r for r in rows if r["kind"] == k]
        if not own:
            continue
        counts: dict[int, int] = {}
        for r in own:
            counts[r["votes"]] = counts.get(r["votes"], 0) + r["n"]
        chance, reliability[name] = fit_votes(counts)
        hit = sum(r["n"] * chance[r["votes"]] for r in own) + 1
        miss = sum(r["n"] * (1 - chance[r["votes"]]) for r in own) + 1
        prior[name] = math.log(hit / miss)
        weights[name] = []
        for f in range(len(FEATURES)):
            on = [r for r in own if r["features"] >> f & 1]
            a = (sum(r["n"] * chance[r["votes"]] for r in on) + 1) / (hit + 1)
            b = (sum(r["n"] * (1 - chance[r["votes"]]) for r in on) + 1) / (miss + 1)
            weights[name].append((math.log(a / b), math.log(max(1 - a, 1e-9) / max(1 - b, 1e-9))))
    return SpanModel(prior, weights, reliability)


def _accepted(x: Column, model: SpanModel) -> Column:
    """Whether the classifier takes a candidate."""
    verdict = F.lit(False)
    for k, name in enumerate(KINDS):
        if name in model.prior:
            score = F.lit(model.prior[name])
            for f, (on, off) in enumerate(model.weights[name]):
                is_on = F.shiftright(x["features"], f).bitwiseAND(F.lit(1)) == 1
                score = score + F.when(is_on, on).otherwise(off)
            verdict = F.when(x["kind"] == k, score > 0).otherwise(verdict)
    return verdict


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ","
    )


def _added(base: Column, extra: Column, model: SpanModel) -> Column:
    """All spans (s, kind, e), by start and then by kind."""
    plain = lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"))
    return F.sort_array(
        F.concat(F.transform(base, plain), F.transform(F.filter(extra, lambda x: _accepted(x, model)), plain))
    )


def find_private(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row of ``docs``.

    ``base`` and ``spans`` list kind:start:end, the end exclusive, in code points.
    """
    model = model or train(docs)
    held = _with_spans(docs, ["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return held.select(
        "row.doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(N_BASE)],
        _listed(F.col("base")).alias("base"),
        _listed(_added(F.col("base"), F.col("extra"), model)).alias("spans"),
    )


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets.

    Overlapping spans become one, named after the first; null texts stay null.
    """
    model = model or train(docs)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    held = _with_spans(docs, docs.columns)
    text = F.col("text")

    def masked(spans: Column) -> Column:
        # up to where earlier spans reach
        reach = F.aggregate(
            spans, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.greatest(F.element_at(done, -1), x["e"])))
        )
        piece = lambda done: F.transform(
            spans,
            lambda x, i: F.when(
                x["s"] < F.get(done, i), ""
            ).otherwise(
                F.concat(F.substr(text, F.get(done, i) + 1, x["s"] - F.get(done, i)), F.get(names, x["kind"]))
            ),
        )
        tail = lambda done: F.substr(text, F.element_at(done, -1) + 1, F.length(text))
        return bind(reach, lambda done: F.concat(F.array_join(piece(done), ""), tail(done)))

    spans = _added(F.col("base"), F.col("extra"), model)
    clean = bind(spans, lambda s: F.when(F.size(s) == 0, text).otherwise(masked(s)))
    own = F.col("row.text")
    return held.select(F.col("row").withField("text", F.when(own.isNotNull(), clean)).alias("row")).select("row.*")


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )
