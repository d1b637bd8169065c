"""Language identification by fusing evidence.

The text gives a likelihood: hashed byte trigrams counted for each language over all
labelled documents. A page of the document, where there is one, adds the language that its
markup declares, the suffix of its address, and its host; documents without a page have
their source as host. How far declarations and suffixes can be trusted is estimated from
how they go together with what the texts say, so unrelated evidence weighs nothing. The
host's prior is its own mixture of languages, smoothed by its domain's and that by the
overall one, without the document itself. All of these come from grouped sums.

A document is rejected if its text has no trigram, if no language reaches the least
confidence, or if the text is in none of the languages. For the latter the share of the
trigrams inside words is taken that a language explains better than chance. What a foreign
text looks like is learned from the labelled ones: of each, the largest share that one of
the *other* languages explains, whose counts do not hold it. A text stays if its best language
explains more of it than the median of these, less a margin that is wider for short texts. So
the bar does not rise with how much the labelled texts resemble each other, and a text unlike
them, but in one of the languages, stays. Numbers, addresses and marks between words do not
count, so a text full of them is judged by its words; a text without words is judged by all
its trigrams. A short text in a language that shares most of its trigrams with one of
``LANGUAGES`` can still pass.

Cases: a null or empty text, or one under three bytes, is rejected, its language is what
the other evidence says; labels outside ``LANGUAGES`` and null labels do not train; without
any labels all languages are equal and everything is rejected; several pages of an id give
the first by address; a null id has no page; repeated rows are judged each; missing pages,
declarations, suffixes or sources add nothing; equal scores go to the alphabetically first
language; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm.common import lean, lower_ascii, stored, table
from fiscalake.llm.urls import host_suffix, registered_domain, url_host

LANGUAGES = ("de", "en", "es", "fr")
BUCKETS = 1 << 15
#: Neighbouring trigrams are not independent: each counts so much, and so many at most.
GRAM_WEIGHT, MOST_GRAMS = 0.2, 500
#: Pseudo-counts: of a trigram, of the prior of a host or domain, of declarations and suffixes.
GRAM_SMOOTHING, HOST_SMOOTHING, EVIDENCE_SMOOTHING = 0.5, 20.0, 5.0
LEAST_CONFIDENCE = 0.4
#: Share of trigrams that a language must explain: learned from labelled texts of so many
#: trigrams at least, the bounds it is held in, and the margin of a text of one trigram.
SHARE_GRAMS, SHARE_BOUNDS, SHARE_SPREAD = 20, (0.2, 0.5), 0.3

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_DECLARED = r"(?i)<html\b[^>]*?\slang\s*=\s*[\x22']?([a-z]{2,3})"


def gram_slots(text: str | None) -> np.ndarray:
    """The slot of every byte trigram of a text."""
    raw = np.frombuffer((text or "").encode("utf-8").translate(_FOLD), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.empty(0, dtype=np.int64)
    packed = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (packed * np.uint32(2654435761) >> np.uint32(32 - 15)).astype(np.int64)


def inside_words(text: str | None) -> np.ndarray:
    """Which byte trigrams have a letter in the middle and letters or blanks beside it."""
    raw = np.frombuffer((text or "").encode("utf-8").translate(_FOLD), dtype=np.uint8)
    if len(raw) < 3:
        return np.empty(0, dtype=bool)
    letter = (raw >= 0x80) | ((raw >= 0x61) & (raw <= 0x7A))
    beside = letter | (raw == 0x20) | (raw == 0x0A)
    return beside[:-2] & letter[1:-1] & beside[2:]


def explained_shares(text: str | None, found: np.ndarray) -> tuple[int, np.ndarray]:
    """Trigrams judged, and the share of them that each language explains better than chance.

    ``found`` has the log likelihood of every trigram (row) in every language (column).
    """
    words = inside_words(text)
    judged = found[words] if words.any() else found
    if not len(judged):
        return 0, np.zeros(found.shape[1])
    return len(judged), (judged > -np.log(BUCKETS)).mean(axis=0)


def gram_counts(docs: DataFrame, languages=LANGUAGES) -> np.ndarray:
    """Counts of every slot and language over all rows of ``docs`` (text, lang).

    Tasks add up their rows first; slots times languages numbers come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if lang in languages:
                    slots, n = np.unique(gram_slots(text), return_counts=True)
                    total[languages.index(lang), slots] += n
        lang, slot = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"l": pa.array(lang, pa.int32()), "slot": pa.array(slot, pa.int32()), "n": pa.array(total[lang, slot])}
        )

    counted = docs.select("text", "lang").mapInArrow(lean(count), "l int, slot int, n bigint")
    rows = counted.groupBy("l", "slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((len(languages), BUCKETS))
    out[rows["l"].to_numpy(), rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out


def gram_weights(counts: np.ndarray) -> np.ndarray:
    """Log likelihood of every slot (row) in every language (column)."""
    shares = counts + GRAM_SMOOTHING
    return np.log(shares / shares.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()


def text_scores(
    docs: DataFrame, weights: np.ndarray, languages=LANGUAGES, carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, source, lang, n_grams, scores, judged, share, foreign) of every row.

    ``scores`` are the text's log likelihoods, ``judged`` its trigrams inside words, ``share`` what
    the best language explains of them, and ``foreign`` what the best other one than its label
    does. The text columns in ``carry`` are returned as well.
    """
    packed, n_languages = weights.tobytes(), weights.shape[1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.frombuffer(packed, dtype=np.float32).reshape(-1, n_languages)
        for batch in batches:
            grams, scores, judged, shares, foreign = [], [], [], [], []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                slots = gram_slots(text)
                n = len(slots)
                scale = GRAM_WEIGHT * min(n, MOST_GRAMS) / max(n, 1)
                grams.append(n)
                found = weight[slots]
                scores.append(found.sum(axis=0, dtype=np.float64) * scale)
                of, share = explained_shares(text, found)
                judged.append(of)
                shares.append(float(share.max()))
                others = [x for x, name in zip(share.tolist(), languages) if name != lang]
                foreign.append(max(others, default=0.0) if lang in languages else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    **{name: batch.column(name) for name in carry},
                    "source": batch.column("source"),
                    "lang": batch.column("lang"),
                    "n_grams": pa.array(grams, pa.int64()),
                    "scores": pa.array(scores, pa.list_(pa.float64())),
                    "judged": pa.array(judged, pa.int64()),
                    "share": pa.array(shares, pa.float64()),
                    "foreign": pa.array(foreign, pa.float64()),
                }
            )

    key = docs.schema["doc_id"].dataType.simpleString()
    text = lambda name: F.col(name).cast("string").alias(name)
    carried = "".join(f", {name} string" for name in carry)
    return docs.select("doc_id", *carry, text("source"), text("lang"), "text").mapInArrow(
        lean(score),
        f"doc_id {key}{carried}, source string, lang string, n_grams bigint, scores array<double>, judged bigint, share double, foreign double",
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """(doc_id, host, suffix, declared) of every page (page_id, url, html)."""
    first = pages.where(F.col("page_id").isNotNull()).groupBy(F.col("page_id").alias("doc_id")).agg(
        F.min(
            F.struct(
                url_host(F.col("url")).alias("host"),
                lower_ascii(F.regexp_extract(F.coalesce("html", F.lit("")), _DECLARED, 1)).alias("declared"),
            )
        ).alias("p")
    )
    filled = lambda c: F.when(F.length(c) > 0, c)
    return first.select(
        "doc_id",
        filled(F.col("p.host")).alias("host"),
        filled(host_suffix(F.col("p.host"))).alias("suffix"),
        filled(F.col("p.declared")).alias("declared"),
    )


def _softmax(scores: Column) -> Column:
    most = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - most))
    total = F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    return F.transform(raised, lambda e: e / total)


def _sums(n: int, prefix: str) -> list[Column]:
    return [F.sum(F.get("p", F.lit(k))).alias(f"{prefix}{k}") for k in range(n)]


def _likelihoods(rows: DataFrame, name: str, n: int) -> DataFrame:
    """(name, array of log P(value | language)); one row for each value that occurs."""
    values = stored(rows.where(F.col(name).isNotNull()).groupBy(name).agg(*_sums(n, "c")), name)
    total = values.agg(F.count(F.lit(1)), *[F.sum(f"c{k}") for k in range(n)]).first()
    kinds = total[0] or 1
    overall = sum(total[1 + k] or 0.0 for k in range(n))
    # smoothed towards the value's overall share: rare pairs of value and language say little
    share = (sum((F.col(f"c{k}") for k in range(n)), F.lit(0.0)) + 1) / (overall + kinds)
    logs = [
        F.log((F.col(f"c{k}") + EVIDENCE_SMOOTHING * share) / ((total[1 + k] or 0.0) + EVIDENCE_SMOOTHING))
        for k in range(n)
    ]
    return values.select(name, F.array(*logs).alias(f"{name}_log"))


def _host_counts(rows: DataFrame, n: int) -> DataFrame:
    """(host, h0.., d0.., g0..): soft counts of each host, its domain, and overall."""
    hosts = stored(
        rows.where(F.col("host").isNotNull())
        .groupBy("host", registered_domain(F.col("host")).alias("domain"))
        .agg(*_sums(n, "h")),
        "language-hosts",
    )
    domains = hosts.groupBy("domain").agg(*[F.sum(f"h{k}").alias(f"d{k}") for k in range(n)])
    return hosts.join(domains, "domain").drop("domain")


def identify_languages(
    docs: DataFrame, pages: DataFrame, languages=LANGUAGES, carry: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, language, confidence, declared, host, n_grams, kept) of every row of ``docs``.

    ``docs`` has (doc_id, text, lang, source), ``pages`` (page_id, url, html).
    The text columns in ``carry`` are returned as well.
    """
    n = len(languages)
    weights = gram_weights(gram_counts(docs, languages))
    scored = text_scores(docs, weights, languages, carry).join(page_evidence(pages), "doc_id", "left")
    rows = stored(
        scored.withColumns({"host": F.coalesce("host", "source"), "p": _softmax(F.col("scores"))}),
        "language-scores",
    )
    foreign = F.when(F.col("judged") >= SHARE_GRAMS, F.col("foreign"))
    whole = rows.agg(F.count(F.lit(1)), *_sums(n, "g"), F.percentile_approx(foreign, 0.5)).first()
    overall = [((whole[1 + k] or 0.0) + 1) / ((whole[0] or 0) + n) for k in range(n)]
    joined = (
        rows.join(_host_counts(rows, n), "host", "left")
        .join(_likelihoods(rows, "declared", n), "declared", "left")
        .join(_likelihoods(rows, "suffix", n), "suffix", "left")
    )
    own = [F.get("p", F.lit(k)) for k in range(n)]
    held = lambda c: [F.coalesce(F.greatest(F.col(f"{c}{k}") - own[k], F.lit(0.0)), F.lit(0.0)) for k in range(n)]
    host, domain = held("h"), held("d")
    smoothed = lambda counts, parent: [
        (c + HOST_SMOOTHING * p) / (sum(counts, F.lit(0.0)) + HOST_SMOOTHING) for c, p in zip(counts, parent)
    ]
    prior = smoothed(host, smoothed(domain, [F.lit(p) for p in overall]))
    zero = F.lit(0.0)
    scores = F.array(
        *[
            F.get("scores", F.lit(k)) + F.log(prior[k])
            + F.coalesce(F.get("declared_log", F.lit(k)), zero) + F.coalesce(F.get("suffix_log", F.lit(k)), zero)
            for k in range(n)
        ]
    )
    posterior = joined.withColumn("posterior", _softmax(scores)).withColumn("confidence", F.array_max("posterior"))
    best = (F.array_position("posterior", F.col("confidence")) - 1).cast("int")
    trained = bool((weights.max(axis=1) > weights.min(axis=1)).any())
    low, high = SHARE_BOUNDS
    bar = min(max(whole[1 + n] or low, low), high)
    known = F.col("share") > F.lit(bar) - SHARE_SPREAD / F.sqrt(F.greatest(F.col("judged"), F.lit(1)))
    kept = (F.col("n_grams") > 0) & (F.col("confidence") >= LEAST_CONFIDENCE) & known & F.lit(trained)
    return posterior.select(
        "doc_id",
        F.get(F.array(*[F.lit(x) for x in languages]), best).alias("language"),
        F.round("confidence", 6).alias("confidence"),
        "declared",
        "host",
        "n_grams",
        kept.alias("kept"),
        *carry,
    )


def op1_evidence_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
