from llm.conftest_llm import ODD_TEXTS

from fiscalake.llm import language as lg

DOCS = "doc_id bigint, text string, lang string, source string"
PAGES = "page_id bigint, url string, html string"
SYLLABLES = {"en": "the th ing er and", "de": "die sch ung ein ich", "fr": "le qu eau ent re", "es": "el ci do os la"}


def text(lang, seed, n=60):
    parts = SYLLABLES[lang].split()
    return " ".join(parts[(seed * 7 + k * k) % 5] + parts[(seed + 3 * k) % 5] for k in range(n))


def corpus():
    return [(100 * j + k, text(lang, k), lang, f"src{k % 3}") for j, lang in enumerate(SYLLABLES) for k in range(40)]


def test_held_out_documents_are_told_apart(frame):
    rows = corpus()
    hidden = {r[0]: r[2] for r in rows if r[0] % 4 == 0}
    docs = frame([(d, t, None if d in hidden else lang, s) for d, t, lang, s in rows], DOCS)
    got = {r.doc_id: r for r in lg.identify_languages(docs, frame([], PAGES)).collect()}
    right = sum(got[d].language == lang for d, lang in hidden.items())
    assert right >= 0.98 * len(hidden)
    assert all(got[d].kept for d in hidden)


def test_pages_host_and_declarations_help_short_texts(frame):
    rows = corpus() + [(900, "", None, "solo"), (901, "ab", "xx", None), (902, None, "en", "src0")]
    url = {"en": "http://a.uk/", "de": "http://a.de/", "fr": "http://a.fr/", "es": "http://a.es/"}
    pages = [(d, url[lang], f'<html lang="{lang.upper()}-x">') for d, _, lang, _ in rows if lang in url and d < 900]
    pages += [(900, "http://a.de/", "<html class=x lang='de'>"), (900, "http://b.zz/", None), (None, None, None)]
    got = {r.doc_id: r for r in lg.identify_languages(frame(rows, DOCS), frame(pages, PAGES)).collect()}
    assert (got[900].language, got[900].declared, got[900].host) == ("de", "de", "a.de")
    assert [got[k].kept for k in (900, 901, 902)] == [False] * 3
    assert all(got[r[0]].language == r[2] and got[r[0]].kept for r in corpus())


def test_odd_texts_repeats_and_no_rows(frame):
    rows = corpus() + [(1000 + k, t, "en", "src1") for k, t in enumerate(ODD_TEXTS)] + corpus()[:2]
    rows += [(None, text("en", 1), "en", None)]
    got = lg.identify_languages(frame(rows, DOCS), frame([], PAGES)).collect()
    assert len(got) == len(rows)
    assert all(not r.kept for r in got if r.n_grams == 0)
    assert lg.identify_languages(frame([], DOCS), frame([], PAGES)).count() == 0
    unlabelled = frame([(1, "some text", None, None)], DOCS)
    assert [r.kept for r in lg.identify_languages(unlabelled, frame([], PAGES)).collect()] == [False]


FOREIGN = [
    "Сегодня хорошая погода, и мы пошли гулять в парк со своими друзьями и собакой.",
    "Oggi il tempo è bello e siamo andati a passeggiare nel parco con i nostri amici e il cane.",
    "Dzisiaj jest ładna pogoda i poszliśmy na spacer do parku z naszymi przyjaciółmi i psem.",
    "今天天气很好，我们和朋友们带着狗去公园散步。",
    " ".join(str(k * k * 7919 % 10**6) for k in range(50)),
    "NFZFsXNUuQKUDKvy4p5DKYNPcMWFVzWZCNDeXu3GIVx2XX1CH2pT7mHIVYygPK9s6WnzWxGXMQvLrLFybgDYBz" * 3,
    "-" * 300,
]


def test_foreign_and_non_language_texts_are_rejected(frame):
    private = '4734663219866878$$$ token = "40d78a45c418324758e099eb7cb89bc0f5fa9f62"### +1 (168) 555-5254 {}'
    clean = [(500 + k, text(lang, 50 + k), None, "src1") for k, lang in enumerate(SYLLABLES)]
    clean += [(510 + k, private.format(text(lang, 60, 6)), None, "src1") for k, lang in enumerate(SYLLABLES)]
    rows = corpus() + clean + [(600 + k, t, None, "src1") for k, t in enumerate(FOREIGN)]
    got = {r.doc_id: r for r in lg.identify_languages(frame(rows, DOCS), frame([], PAGES)).collect()}
    assert [d for d in got if d >= 600 and got[d].kept and d < 700] == []
    assert all(got[d].kept for d in got if d < 600)


#: Ordinary sentences, unlike the invented words of the test tables.
PLAIN = {
    "en": [
        "Please remember to bring your own lunch when you come to the office tomorrow morning.",
        "She walked slowly along the river, thinking about everything her brother had told her.",
    ],
    "de": [
        "Der Ausschuss trifft sich am nächsten Donnerstag, um über den Haushalt und das neue Schulgebäude zu sprechen.",
        "Sie ging langsam am Fluss entlang und dachte an alles, was ihr Bruder gesagt hatte.",
    ],
    "fr": [
        "La commission se réunira jeudi prochain pour discuter du budget annuel et de la nouvelle école.",
        "Elle marchait lentement le long de la rivière en pensant à tout ce que son frère lui avait dit.",
    ],
    "es": [
        "La comisión se reunirá el próximo jueves para hablar del presupuesto anual y de la nueva escuela.",
        "Ella caminaba despacio por la orilla del río pensando en todo lo que su hermano le había dicho.",
    ],
}


def test_clean_texts_unlike_the_training_rows_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(0)
    plain = [t for texts in PLAIN.values() for t in [*texts, " ".join(texts * 20)]]
    foreign = FOREIGN[:1] + FOREIGN[2:]  # Italian is near enough to Spanish and French
    more = [(-1 - k, t, None, None) for k, t in enumerate(plain)] + [(-100 - k, t, None, None) for k, t in enumerate(foreign)]
    found = lg.identify_languages(docs.unionByName(spark.createDataFrame(more, docs.schema)), pages)
    got = {r.doc_id: r for r in found.collect()}
    assert [t for k, t in enumerate(plain) if not got[-1 - k].kept] == []
    assert [t for k, t in enumerate(foreign) if got[-100 - k].kept] == []
    wrong = [r for r in got.values() if r.doc_id >= 0 and not r.kept and r.n_grams >= 10]
    assert len(wrong) <= 0.001 * len(got)


def test_posterior_equals_brute_force(frame):
    """Every number of the method again, in plain loops."""
    import math

    rows = corpus()[::3] + [(900, "the ring der und", "en", "src1"), (901, "le que", None, None)]
    hosts = ["a.de", "b.a.de", "c.fr", "d.example.es"]
    pages = [(d, f"http://{hosts[d % 4]}/x", f'<html lang="{lang or "de"}">') for d, _, lang, _ in rows if d % 2 == 0]
    got = {r.doc_id: r for r in lg.identify_languages(frame(rows, DOCS), frame(pages, PAGES)).collect()}

    names, n = lg.LANGUAGES, len(lg.LANGUAGES)
    counts = {lang: {} for lang in names}
    for _, t, lang, _ in rows:
        for s in lg.gram_slots(t).tolist() if lang else []:
            counts[lang][s] = counts[lang].get(s, 0) + 1
    weight = {}
    for lang, own in counts.items():
        total = sum(own.values()) + lg.GRAM_SMOOTHING * lg.BUCKETS
        weight[lang] = lambda s, own=own, total=total: math.log((own.get(s, 0) + lg.GRAM_SMOOTHING) / total)

    def softmax(xs):
        e = [math.exp(x - max(xs)) for x in xs]
        return [x / sum(e) for x in e]

    at = {d: (u.split("/")[2], h.split('"')[1]) for d, u, h in pages}
    scores, soft, host, suffix, declared = {}, {}, {}, {}, {}
    for d, t, _, source in rows:
        slots = lg.gram_slots(t).tolist()
        scale = lg.GRAM_WEIGHT * min(len(slots), lg.MOST_GRAMS) / max(len(slots), 1)
        scores[d] = [sum(weight[lang](s) for s in slots) * scale for lang in names]
        soft[d] = softmax(scores[d])
        host[d] = at[d][0] if d in at else source
        suffix[d] = at[d][0].rsplit(".", 1)[1] if d in at else None
        declared[d] = at[d][1] if d in at else None
    domain = {d: ".".join(h.split(".")[-2:]) if h else None for d, h in host.items()}

    def summed(of, value):
        return [sum(soft[d][k] for d in soft if of[d] == value) for k in range(n)]

    whole = [sum(p[k] for p in soft.values()) for k in range(n)]
    overall = [(w + 1) / (len(rows) + n) for w in whole]
    for d in soft:
        prior = overall
        for of in (domain, host):
            held = [max(x - y, 0.0) if of[d] else 0.0 for x, y in zip(summed(of, of[d]), soft[d])]
            prior = [(h + lg.HOST_SMOOTHING * p) / (sum(held) + lg.HOST_SMOOTHING) for h, p in zip(held, prior)]
        total = [s + math.log(p) for s, p in zip(scores[d], prior)]
        for of in (declared, suffix):
            kinds = {v for v in of.values() if v}
            sums = {v: summed(of, v) for v in kinds}
            every = [sum(s[k] for s in sums.values()) for k in range(n)]
            if of[d]:
                share = (sum(sums[of[d]]) + 1) / (sum(every) + len(kinds))
                for k in range(n):
                    smooth = lg.EVIDENCE_SMOOTHING
                    total[k] += math.log((sums[of[d]][k] + smooth * share) / (every[k] + smooth))
        posterior = softmax(total)
        assert got[d].language == names[posterior.index(max(posterior))]
        assert abs(got[d].confidence - max(posterior)) < 1e-4, d
