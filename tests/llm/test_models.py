"""Personal data, main text, toxicity, language ID, the pipeline."""
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from viewtide.llm import decontam, html_main, jaccard_join, lang_id, mixing, pii, token_files, toxicity

from llm_helpers import brute_components, brute_hits

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(digits[::-1])) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_base_spans_match_the_patterns():
    r = random.Random(3)
    bits = ["a@b.c", "x.y@z-1.de.", "@", "a@@b.c", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.02.3.4", "4111 1111 1111 1111",
            "4111111111111112", "+49 (30) 1234-5678", "+1", "+1 2", " ", ".", "-", "é", "+", "12", "5", "\n", "a", "0-0 0"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randrange(1, 12)))
        assert pii.joined(pii.base_spans(text)).split(",") == (brute_spans(text) or [""]), text
    long = "7" * 200_000 + "." * 50_000 + "a" * 100_000 + "@" + "1." * 50_000
    assert isinstance(pii.base_spans(long), list)  # in linear time


def test_tagger_gradient():
    m = pii.BiLstmCrf.start(hidden=3)
    r = np.random.default_rng(0)
    codes, tags = r.integers(0, pii.CLASSES, (3, 7)), r.integers(0, pii.TAGS, (3, 7))

    def loss():
        em, _ = m.emissions(codes)
        z, _, _ = m.marginals(em)
        path = m.p["s"][tags[:, 0]] + em[np.arange(3)[:, None], np.arange(7), tags].sum(axis=1)
        return (z - path - m.p["t"][tags[:, :-1], tags[:, 1:]].sum(axis=1)).mean()

    for k, g in m.gradient(codes, tags).items():
        at = (0, codes[0, 0], 1) if k == "x" else tuple(r.integers(0, n) for n in m.p[k].shape)
        was, e = m.p[k][at], 1e-5
        m.p[k][at] = was + e
        up = loss()
        m.p[k][at] = was - e
        assert abs((up - loss()) / 2 / e - g[at]) < 1e-6
        m.p[k][at] = was


def test_tagger_learns_and_reconciles():
    r = random.Random(5)
    texts = []
    for _ in range(400):
        spot = r.choice(["{}.{}.{}.{}".format(*(r.randrange(256) for _ in range(4))), f"mail{r.randrange(99)}@host.org", f"{r.randrange(10**6)}"])
        texts.append(f"{'word ' * r.randrange(1, 9)}{spot} {'more ' * r.randrange(1, 6)}"[:pii.WINDOW])
    codes = np.stack([pii.char_classes(t) for t in texts])
    tags = np.stack([pii.tags_of(pii.base_spans(t), 0) for t in texts])
    model = pii.BiLstmCrf.start().fit(codes[:300], tags[:300], rounds=150)
    found = [set(s for _, s in w) for w in model.window_spans([(0, t, True) for t in texts[300:]])]
    want = [set(pii.base_spans(t)) for t in texts[300:]]
    assert sum(len(f & w) for f, w in zip(found, want)) >= 0.9 * sum(map(len, want))
    a, b, c = ("ip", 0, 10), ("ip", 8, 20), ("ip", 20, 30)
    assert pii.reconcile([(0.95, a), (0.99, b), (0.93, c), (0.95, c)], []) == [b, c]
    assert pii.reconcile([(0.95, a), (0.5, c)], []) == [a] and pii.reconcile([(0.99, b)], [("card", 19, 25)]) == []


def test_runs_are_joined_across_windows():
    one = (0.95, ("email", 10, 20), False, False)
    long = [(0.97, ("email", 40, 96), False, True), (0.93, ("email", 48, 144), True, True), (0.99, ("email", 96, 150), True, False)]
    other = [(0.9, ("card", 90, 96), False, True), (0.9, ("ip", 96, 99), True, False), (0.9, ("email", 300, 320), True, False)]
    assert sorted(pii.join_runs([one, *long[::-1], *other])) == [(0.93, ("email", 40, 150)), (0.95, ("email", 10, 20))]
    assert pii.join_runs([]) == []


def test_spans_longer_than_a_window(monkeypatch):
    """A tagger that marks every address; the windows of a 200-character one must give it whole."""
    text = "mail to " + "a" * 130 + "7@" + "b" * 60 + ".org now, or to x1@y.de " + "word " * 30
    base = pii.base_spans(text)
    starts = pii.open_windows(text)
    windows = [(s, text[s:s + pii.WINDOW], s + pii.WINDOW >= len(text)) for s in starts]
    model = pii.BiLstmCrf.start()
    monkeypatch.setattr(pii.BiLstmCrf, "emissions", lambda self, x: (np.zeros((len(x), pii.WINDOW, pii.TAGS)), None))
    monkeypatch.setattr(pii.BiLstmCrf, "marginals", lambda self, em: (np.zeros(len(em)), np.zeros_like(em), np.zeros_like(em)))
    monkeypatch.setattr(pii.BiLstmCrf, "viterbi", lambda self, em: [pii.tags_of(base, s) for s in starts])
    found = pii.reconcile(pii.join_runs([r for w in model.window_runs(windows) for r in w]), [])
    assert found == base and max(e - s for _, s, e in base) > 190


def test_many_addresses_in_linear_time():
    import time
    text = "write to a1@b.de, " * 50_000  # some 0.9 MB
    t = time.process_time()
    base = pii.base_spans(text)
    starts = pii.open_windows(text)
    tags = list(pii._labelled([__import__("pyarrow").RecordBatch.from_pydict(
        {"base": [pii.joined(base)], "starts": [starts], "windows": [[text[s:s + pii.WINDOW] for s in starts]]})]))
    assert tags[0].num_rows == len(starts)
    assert pii.reconcile([(0.95, (k, s + 1, e)) for k, s, e in base], base) == []
    assert len(pii.reconcile([(0.95, s) for s in base], [])) == len(base) == 50_000
    assert time.process_time() - t < 30


def test_windows_cover_every_anchor():
    for n in (0, 1, 95, 96, 97, 143, 144, 145, 500):
        for at in range(n):
            starts = pii.open_windows("x" * at + "7" + "x" * (n - at - 1))
            assert any(s <= at < s + pii.WINDOW for s in starts)
    assert pii.open_windows(None) == [] and pii.open_windows("words only") == []


def test_personal_data_query(spark, docs, odd, none):
    for rows in (docs, odd):
        out = pii.find_personal_data(spark, rows, max_windows=40)
        texts = sorted((str(r.doc_id), r.text or "") for r in rows.select("doc_id", "text").collect())
        got = sorted((str(r.doc_id), r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in out.collect())
        want = []
        for d, t in texts:
            s = brute_spans(t)
            want.append((d, hashlib.sha256(",".join(s).encode()).hexdigest(), *(sum(x.startswith(k) for x in s) for k in PATTERNS)))
        assert got == sorted(want)
    assert pii.find_personal_data(spark, none).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x("</p>")</script></head><body class="page">
<div class="cookie-notice">Accept?</div><header><a href=/>Home</a></header><nav><ul><li>One<li>Two</ul></nav>
<div class=sidebar><p>Side</p></div><article class="post"><header><h1>A &amp; B</h1></header><p>First <b>bo</b>ld
 line.<br>Next&nbsp;one<p>Caf&eacute; &lt;tag&gt; &#x41;<ul><li>x<li>y</ul><aside>Related</aside><table><tr><td>1<td>2</table>
<form><input value=1>Mail <button>Go</button></form></article><section id="comments"><p>Nice!</p></section>
<div class="ad">Buy</div><footer>&copy; me</footer>"""


def test_main_text_of_a_page():
    assert html_main.main_text(PAGE) == "A & B First bold line. Next one Café <tag> A x y 1 2"
    assert html_main.main_text(None) == html_main.main_text("") == html_main.main_text("<nav>x") == ""
    assert html_main.main_text("just text &am &amp") == "just text &am &"
    assert html_main.main_text("<body><div>One</b></p><i>two</div><main><p>Three</main>") == "Three"
    assert html_main.main_text("<article>a<!-- b --><![CDATA[c]]><script>d<p></script>e<textarea>f</textarea></article>") == "ace"
    assert html_main.main_text("<article><p>a < b and <3 c</p><a title='x>y' href=q>z</a>") == "a < b and <3 c z"
    assert html_main.main_text("<article>" * 500 + "deep" + "</div>" * 9) == "deep"


def test_a_teaser_is_no_root():
    story = "The story of the day is told here at some length. " * 4
    teaser = "<article><p>Read this too</p></article>"
    assert html_main.main_text(f"<main><p>{story}</p></main>{teaser}") == story.strip()
    assert html_main.main_text(f"<div><p>{story}</p></div>{teaser}") == f"{story}Read this too"
    assert html_main.main_text(f"<article><p>{story}</p></article><main><p>More</p></main>") == story.strip()


def test_deep_pages_have_bounded_paths():
    deep = "<article>" + "<div class='aa'>x" * 5_000 + "</article>"
    page = html_main.Page(deep)
    assert max(p.count("/") for p in page.path) == html_main.DEPTH
    assert html_main.main_text(deep) == " ".join("x" * 5_000)


def site(spark, n=24):
    rows = [(k, f"https://Site.example/{k}", f"<html><body><div class='zz'><p>Welcome to our site</p></div><div class='qq'><p>Text {k} "
             f"with own words {k * 7}</p><p>Second {k}</p></div></body></html>") for k in range(n)]
    rows += [(100, None, None), (101, "no url", "<p>Solo"), (102, "https://same.example", "<article><p>Copy</p></article>"),
             (102, "https://same.example", "<article><p>Copy</p></article>")] + [
                 (200 + k, "https://same.example", "<article><p>Copy</p></article>") for k in range(9)]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, path string")


@pytest.mark.parametrize("bound", [None, 0])
def test_style_tree_removes_the_template(spark, bound):
    out = html_main.extract_main_text(spark, site(spark), bound).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == 24 + 13 and got[100] == "" and got[101] == "Solo"
    assert all(got[k] == f"Text {k} with own words {k * 7} Second {k}" for k in range(24))
    assert got[102] == got[208] == "Copy" and all(r.n_chars == len(r.text) for r in out)  # copies keep their text


@pytest.mark.parametrize("bound", [None, 0])
def test_copies_without_an_article_element_keep_their_text(spark, bound):
    page = "<body><div class='zz'><p>Welcome to our site</p></div><div class='qq'><p>{}</p><p>{}</p></div></body>"
    rows = [(k, "https://copies.example", page.format(*(("Copy one", "Copy two") if k % 4 else (f"Own {k}", f"Text {k}")))) for k in range(80)]
    rows += [(100 + k, "https://same.example", "<body><div><p>Only text</p></div><nav>Link {k}</nav></body>") for k in range(9)]
    few = [[f"b{k % 3}", f"b{(k + 1) % 3}", f"b{k // 3 % 3}", f"b{k // 9}"] for k in range(27)]  # every block on many pages
    rows += [(200 + k, "https://mixed.example", "<div>" + "".join(f"<p>{w}</p>" for w in f) + "</div>") for k, f in enumerate(few)]
    got = {r.page_id: r.text for r in html_main.extract_main_text(
        spark, spark.createDataFrame(rows, "page_id long, url string, html string"), bound).collect()}
    assert all(got[k] == ("Copy one Copy two" if k % 4 else f"Own {k} Text {k}") for k in range(80))
    assert all(got[100 + k] == "Only text" for k in range(9))
    assert all(got[200 + k] == " ".join(f) for k, f in enumerate(few))


def test_main_text_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r.page_id: r.text for r in html_main.extract_main_text(spark, pages).collect()}
    for r in pages.collect():
        body = re.search(r"(?s)<article>(.*)</article>", r.html).group(1)
        body = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|br|h1)>", " ", body))
        assert out[r.page_id] == " ".join(html.unescape(body).split())
    assert html_main.extract_main_text(spark, pages.limit(0)).count() == 0


def test_factorization_machine_learns_a_pair():
    r = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    rows, y = [], []
    for k in range(1500):  # 'oaf' or 'folk' alone is harmless, together they are toxic
        extra = [["oaf"], ["folk"], ["oaf", "folk"], []][k % 4]
        rows.append(" ".join(r.sample(words, 8) + extra))
        y.append(int(len(extra) == 2))
    model = toxicity.fit([np.array(sorted(toxicity.term_buckets(t))) for t in rows], np.array(y))
    score = model.score(["w1 w2 oaf folk", "w1 oaf", "folk w3", "w4 w5", "", None])
    assert score[0] > 0.7 and (score[1:] < 0.3).all() and score[4] == score[5]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.score_toxicity(spark, docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted and not r.toxic for r in rows) <= 2
    assert sum(r.predicted and r.toxic for r in rows) >= 0.6 * sum(r.toxic for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out.collect())


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 1), (2, None, None), (3, 0, 0), (5, 0, 0), (5, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(spark, odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert toxicity.score_toxicity(spark, none, labels).count() == 0
    assert {r.predicted for r in toxicity.score_toxicity(spark, odd, labels.limit(0)).collect()} == {0}


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lang_id.identify(spark, docs).collect()
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_rejects_foreign_and_random_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_id.train(spark, docs)
    r = random.Random(2)
    scripts = ["abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz", "абвгдежзийклмнопрстуфхцчшщыьэюя", "αβγδεζηθικλμνξοπρστυφχψω",
               [chr(0x4E00 + k) for k in range(3000)]]
    for letters in scripts:
        for words in (3, 20, 100, 500, 3000):
            texts = [" ".join("".join(r.choices(letters, k=r.randrange(2, 10))) for _ in range(words)) for _ in range(5)]
            assert model.predict(texts)[2].all(), (letters[0], words)
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem. "
    assert model.predict([polish, polish * 20, polish * 200])[2].all()
    held = [r.text for r in docs.where(lang_id.held_out()).collect()]
    assert model.predict(held)[2].mean() <= 0.01


def test_language_training_rows(spark):
    """The cut by hash before the window leaves each language's first rows by hash as they are."""
    docs = spark.range(20_000).selectExpr("id doc_id", "'a b' text", "if(id % 10 < 7, 'aa', if(id % 10 < 9, 'bb', null)) lang")
    got = {r.t_id for r in lang_id.training_ids(spark, docs, 200).collect()}
    rows = docs.where(docs.lang.isNotNull() & ~lang_id.held_out()).selectExpr("doc_id", "lang", "xxhash64(doc_id) h").collect()
    for lang in ("aa", "bb"):
        own = sorted((r.h, r.doc_id) for r in rows if r.lang == lang)
        assert {d for _, d in own[:100]} == {d for d in got if any(d == i for _, i in own)}


def test_language_odd_rows(spark, odd, none):
    out = lang_id.identify(spark, odd).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    assert {d for d, r in by.items() if r.lang_pred == "und"} == {None, 2, 3, 4, 11} - {None} | ({None} if by[None].lang_pred == "und" else set())
    kept = lang_id.drop_rejected(spark, odd)
    assert kept.columns == odd.columns and not {2, 3, 4, 11} & {r.doc_id for r in kept.collect()}
    assert lang_id.identify(spark, none).count() == 0
    assert {r.lang_pred for r in lang_id.identify(spark, odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_letters():
    text = lambda t: "".join(map(chr, lang_id.letters(t)))
    assert text("Ab, c1D\né") == " ab c d é " and text("12 !") == text("") == text(None) == ""
    assert text("𝒳x") == " 𝒳x "


def test_pipeline_against_brute_force(spark):
    from tokenizers import Tokenizer
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [r for r in docs.collect()]
    rejected = lang_id.train(spark, docs).predict([r.text for r in rows])[2]
    rows = [r for r, x in zip(rows, rejected) if not x]
    comp = brute_components([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if comp[r.doc_id][1] == r.doc_id]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hits = [brute_hits(r.text, items) for r in rows]
    rows = [r for r, (n, h, _) in zip(rows, hits) if not (h and 20 * h >= n)]
    left = spark.createDataFrame(rows, docs.schema)
    times = {r.doc_id: r.n_copies for r in mixing.mix(spark, left).collect()}  # held against SQL in its own tests
    tok = Tokenizer.from_file(token_files.tokenizer_path())
    want, start = [], 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4")
        for _ in range(times[r.doc_id]):
            want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect()) == want


def test_pipeline_stages_keep_the_columns(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == odd.columns
        out.collect()
        docs = out
    assert {"doc_id", "start", "n_tokens", "ids_crc32"} == set(corpus_pipeline.STAGES[-1][1](spark, odd, "").columns)
    assert decontam and jaccard_join
