"""Toxicity, extraction and personal data: per-document operators."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import html, pii, toxicity
from strata.llm.text import text_batches

from .conftest import documents, odd_texts, sentence

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    """The contract read as four regular expressions over the whole text."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), m.end(), "card") for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.BASE_KINDS.index(s[2])))


def test_base_spans_equal_the_expressions():
    rng = random.Random(3)
    for alphabet in ("01.9+@a- b(c)٣", "0 -4", "a@.b", "+1 ()-.", "0123456789.", "AZaz@._%+-İß"):
        for _ in range(8000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
            assert [s for s in pii.find_spans(text) if s[2] in pii.BASE_KINDS] == base_spans(text), text


def test_values_planted_in_text():
    text = "é mail jo.81@mail7.example.com, ip 10.0.0.255 card 4111 1111-1111 1111 call +49 (30) 1234-5678. IBAN: DE89 3704 0044 0532 0130 00 see https://x.example/a?b=1."
    kinds = {kind: text[a:b] for a, b, kind in pii.find_spans(text)}
    assert kinds == {"email": "jo.81@mail7.example.com", "ip": "10.0.0.255", "card": "4111 1111-1111 1111", "phone": "+49 (30) 1234-5678",
                     "account": "DE89 3704 0044 0532 0130 00", "url": "https://x.example/a?b=1"}
    assert not [s for s in pii.find_spans("IBAN: DE88 3704 0044 0532 0130 00") if s[2] == "account"]
    assert pii.find_spans("passport no. AB1234567 here")[0] == (13, 22, "account")


def test_cues_and_schemes_beside_letters_that_grow_in_lower_case():
    text = "İstanbul IBAN DE89 3704 0044 0532 0130 00, SSN 123-45-6789, HTTP://X.example/a"
    assert [(kind, text[a:b]) for a, b, kind in pii.find_spans(text) if kind in ("account", "url")] == [
        ("account", "DE89 3704 0044 0532 0130 00"), ("account", "123-45-6789"), ("url", "HTTP://X.example/a")]


def test_pii_rows_and_edge_cases(spark, rng):
    rows = list(enumerate([*odd_texts(rng), "a@b.co " * 3, "a@b.co " * 3])) + [(None, "1.2.3.4")]
    out = pii.find_pii(documents(spark, rows, extra=True)).collect()
    assert len(out) == len(rows)
    for r in out:
        text = dict(rows)[r.doc_id] or ""
        base = base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in base) for k in pii.BASE_KINDS]
    assert pii.find_pii(documents(spark, [])).count() == 0


# ------------------------------------------------------------------ toxicity

MARKERS = ("idiot", "scum", "trash", "loser")


def labelled(rng, n):
    rows = []
    for i in range(n):
        words = sentence(rng, rng.choice((5, 30, 90, 300))).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(1 + len(words) // 60):
                words[rng.randrange(len(words))] = rng.choice(MARKERS)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy_on_planted_words(spark, rng):
    rows = labelled(rng, 700)
    docs = documents(spark, [(i, t) for i, t, _ in rows], extra=True).drop("score")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    out = {r.doc_id: r for r in toxicity.score(docs, model).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()}
    test = [(out[i].score >= 0.5, y) for i, _, y in rows if out[i].held]
    assert len(test) > 100
    assert sum(p == y for p, y in test) / len(test) > 0.95


def test_labels_of_held_out_rows_are_not_learnt(spark, rng):
    rows = labelled(rng, 200)
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    import zlib
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows]
    one = toxicity._training_windows(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), 4000, 12)
    two = toxicity._training_windows(docs, spark.createDataFrame([(i, 1 - y if h else y) for (i, _, y), h in zip(rows, held)], "doc_id long, toxic int"), 4000, 12)
    assert one == two and {d for d, _, _ in one[0]} == {i for (i, _, _), h in zip(rows, held) if not h}


def test_every_window_is_scored(rng):
    """The score of a text is the largest of its windows scored one by one."""
    net = toxicity.fit([(i, y, t) for i, t, y in labelled(rng, 60)], 0.25, epochs=1)
    texts = [sentence(rng, n) for n in (0, 1, 63, 64, 65, 111, 112, 113, 500)]
    for _, _, data, offsets in text_batches(pa.array(texts)):
        got = toxicity.score_bytes(net, data, offsets)
    for text, score in zip(texts, got):
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", text.lower())
        parts = [" ".join(words[a : a + 64]) for a in range(0, max(1, len(words) - 64 + 48), 48)] or [""]
        alone = []
        for p in parts:
            for _, _, data, offsets in text_batches(pa.array([p])):
                alone.append(toxicity.score_bytes(net, data, offsets)[0])
        assert abs(max(alone) - score) < 1e-4


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(toxicity, "_sigmoid", lambda x: 1 / (1 + np.exp(-x)))
    rng = np.random.default_rng(0)
    net = toxicity.Network(np.arange(10, dtype=np.uint64))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids, chars = np.array([0, 3, 5, 7, 2]), rng.standard_normal((5, toxicity.CHAR_DIM))
    length = np.array([4, 6, 2, 0])
    index = np.where(np.arange(6)[None] < length[:, None], rng.integers(0, 5, (4, 6)), 5)
    y = np.array([1, 0, 1, 0.0])

    def loss():
        z = net.forward(net.project(ids, chars), index, length)
        return (np.logaddexp(0, z) - y * z).sum()

    proj, tape = net.project(ids, chars), {}
    z = net.forward(proj, index, length, tape)
    g, _ = net.backward(proj, tape, 1 / (1 + np.exp(-z)) - y)
    for k, v in g.items():
        flat = net.p[k].reshape(-1)
        for i in rng.integers(len(flat), size=3):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - v.reshape(-1)[i]) < 2e-4, k


def test_scores_of_odd_rows_and_without_labels(spark, rng):
    rows = [*enumerate(odd_texts(rng)), (0, None), (None, "idiot")]
    docs = documents(spark, rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert len(out) == len(rows) and all(r.score == 0 for r in out)
    more = labelled(rng, 120)
    labels = spark.createDataFrame([(i, y) for i, _, y in more] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(documents(spark, [(i, t) for i, t, _ in more]), labels)
    scores = toxicity.score(docs, model, ("lang", "n_chars")).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores) and scores[0].lang == "en"
    assert toxicity.score(documents(spark, []), model).count() == 0


# ---------------------------------------------------------------- extraction

def own_pages(rng, n):
    out = []
    for _ in range(n):
        body = "".join(f"<p>{sentence(rng, rng.randint(5, 40))}.</p>" for _ in range(rng.randint(1, 6)))
        out.append(f"<html><head><title>t</title><style>p{{}}</style><script>var a='</p>'</script></head><body><nav><ul><li><a href='/'>home</a></li><li><a href='/b'>news</a></li></ul></nav>"
                   f"<div class='ad'>buy {sentence(rng, 5)}</div><article><h1>{sentence(rng, 6)}</h1>{body}</article><footer>&copy; {sentence(rng, 6)}</footer></body></html>")
    return out


@pytest.fixture(scope="module")
def model():
    return html.fit(html.training_pages(own_pages(random.Random(1), 40)))


PAGE = """<!DOCTYPE html><html><body><header><h2>The Site</h2></header><nav><a href=/>Home</a> <a href=/n>News</a></nav>
<div class="cookie-notice"><p>We use cookies.</p></div><aside class="sidebar"><p>Most read stories of the week.</p></aside>
<article><h1>A   headline &amp; more</h1><p>First para&shy;graph with <b>bold</b>&nbsp;and<br>a <a href=x>link</a>, long enough to be a text.<p>Second one, unclosed &lt;tag&gt; of the story.
<ul><li>One point of the story.<li>Another point of the story.</ul><div class="advert"><p>Buy now and save.</p></div><script>p("<p>no</p>")</script><!-- <p>no</p> --></article>
<form><label>Your name</label><textarea>typed text</textarea></form><section id="comments"><div class="comment"><p>I liked the story a lot, thank you all.</p></div></section><footer>&copy; The Site</footer></body></html>"""


def test_extraction_of_a_page(model):
    assert html.main_text(PAGE, model).split("\n\n") == [
        "A headline & more", "First para\xadgraph with bold and a link, long enough to be a text.", "Second one, unclosed <tag> of the story.",
        "One point of the story.", "Another point of the story."]


@pytest.mark.parametrize("head", [
    "<head><title>The <b>title</b></title><meta charset=utf-8><link rel=x href=y><style>p{}</style><body>",
    "<head><title>Title</title>", "<head><title>Unclosed title<body>", "<head><meta charset=utf-8><script>var a='<p>'</script></head><body>",
    "<body><svg viewBox='0 0 1 1' aria-label=\"a > b\"/>", "<body><svg/><svg class=x />", "<body><svg><path d='x'/><title>icon</title></svg>"])
def test_extraction_of_pages_without_end_of_head_or_with_closed_svg(model, head):
    article = PAGE[PAGE.index("<article>") :]
    want = html.main_text(f"<html><body>{article}", model)
    assert want.startswith("A headline & more") and html.main_text(f"<!DOCTYPE html><html>{head}{article}", model) == want


def test_text_ends_a_head():
    assert [b.text for b in html.leaf_blocks("<head><title>t</title>\n One <b>text</b>.<p>Two")] == ["One text.", "Two"]
    assert [b.text for b in html.leaf_blocks("<head><title>How to use <body> tags</title></head><body><p>One")] == ["One"]


def test_extraction_of_unseen_layouts(model):
    pages = html.training_pages(own_pages(random.Random(2), 40), variants=5, seed=5)
    wrong = sum(a != b for rows, y in pages for a, b in zip(model.decode(rows), y))
    assert wrong / sum(len(y) for _, y in pages) < 0.02


def test_viterbi_and_likelihood_equal_enumeration():
    import itertools
    model = html.Model({"a": 0.7, "b": -1.1}, [[0.2, -0.3], [-0.5, 0.9]], [0.1, -0.2])
    rows = [("a",), ("b",), ("a", "a"), ("b",), ("a",)]

    def score(y):
        s = model.start[y[0]] + sum(model.weights[f] for r, k in zip(rows, y) if k for f in r)
        return s + sum(model.change[p][q] for p, q in zip(y, y[1:]))

    best = max(itertools.product((0, 1), repeat=len(rows)), key=score)
    assert model.decode(rows) == list(best)


def test_fit_samples_pages_with_landmarks(spark):
    own = own_pages(random.Random(4), 6)
    plain = [(100 + i, "u", f"<html><body><div><p>page {i} of no landmark</p></div></body></html>") for i in range(3000)]
    schema = "page_id long, url string, html string"
    model = html.train(spark.createDataFrame([*plain, *((i, "u", p) for i, p in enumerate(own))], schema), sample=6)
    alone = html.train(spark.createDataFrame([(i, "u", p) for i, p in enumerate(own)], schema), sample=6)
    assert model.weights and model.weights == alone.weights
    with pytest.raises(ValueError):
        html.train(spark.createDataFrame(plain, schema))


def test_letters_of_a_whole_block():
    blocks = html.leaf_blocks("<p>" + "a" * 400 + "1" * 1600 + "</p>")
    assert "alpha:0" in html.features(blocks)[0]


def test_extraction_edge_cases(spark, model):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "plain text without any markup"), (4, "u", PAGE), (4, "u", PAGE), (None, "u", "<p>unclosed <b>x"),
             (5, "u", "</div></p><<< a < b <!-- "), (6, "u", "<article>" + "<p>para graph of words.</p>" * 3000 + "</article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "score": F.lit(1)})
    out = html.extract(df, model).collect()
    assert len(out) == len(pages) and all(r.n_chars == len(r.text) for r in out)
    by = {r.page_id: r.text for r in out}
    assert by[1] == by[2] == "" and by[4].startswith("A headline") and by[6].count("\n\n") == 2999
    assert html.extract(df.limit(0), model).count() == 0
    assert html.main_text("<article><p>x y z.</p></article>", html.train(df.limit(0))) == ""
