"""Classifiers, language model, page text and the pipeline."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import common, html_text, interpolation, line_quality, toxicity
from tallyhouse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return common.Slice(None, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), np.frombuffer(b"".join(raw), dtype=np.uint8))


def test_words_and_shingles():
    texts = ["A b\tc", "", " x ", "one\ntwo three four five six", "é漢 É", "end\n", "\n", "a" * 5]
    row, start, end, found = common.words(slice_of(texts))
    want = [(k, w) for k, t in enumerate(texts) for w in re.findall("[^\x20\x09-\x0d]+", t.translate(LOWER))]
    assert row.tolist() == [k for k, _ in want]
    ids = {}
    assert all(ids.setdefault(w, h) == h for (_, w), h in zip(want, found.tolist())) and len(set(ids.values())) == len(ids)
    rows, hashes = common.shingles(row, found)
    runs = [(k, tuple(w[i : i + 5])) for k, t in enumerate(texts) for w in [re.findall("[^\x20\x09-\x0d]+", t.translate(LOWER))] if w for i in range(max(1, len(w) - 4))]
    assert rows.tolist() == [k for k, _ in runs] and len(set(hashes.tolist())) == len({r for _, r in runs})


def test_lines():
    texts = ["a\nb", "", "\n", "x\n\ny\n", "z"]
    row, size, x = line_quality.line_features(slice_of(texts))
    assert [(r, n) for r, n in zip(row.tolist(), size.tolist())] == [(0, 1), (0, 1), (2, 0), (3, 1), (3, 0), (3, 1), (4, 1)]
    assert x.shape == (7, line_quality.FEATURES) and np.isfinite(x).all()


def test_marginals_against_all_paths():
    rng = np.random.default_rng(0)
    row = np.array([0, 0, 0, 1, 2, 2, 2, 2])
    emission, transition = rng.normal(size=8), rng.normal(size=(2, 2))
    odds, _, _ = line_quality.marginals(row, emission, transition)
    for doc in range(3):
        at = np.flatnonzero(row == doc)
        mass = np.zeros((len(at), 2))
        for path in np.ndindex(*[2] * len(at)):
            score = sum(emission[i] * y for i, y in zip(at, path)) + sum(transition[a, b] for a, b in zip(path, path[1:]))
            for k, y in enumerate(path):
                mass[k, y] += math.exp(score)
        assert np.allclose(odds[at], np.log(mass[:, 1] / mass[:, 0]))


def accuracy(spark, name, label, held_score):
    got = QUERIES[name](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col(label).alias("label"))
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert got.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert got.where("score < 0 or score > 1 or score is null").isEmpty()
    return sum(r.predicted == r.label for r in rows) / len(rows)


def test_quality_held_out(spark):
    assert accuracy(spark, "op5_quality_classifier", "quality", 0.3) > 0.95


def test_toxicity_held_out(spark):
    assert accuracy(spark, "op9_toxicity", "toxic", 0.7) > 0.9


@pytest.mark.parametrize("module", [line_quality, toxicity])
def test_classifiers_on_odd_tables(spark, module, docs, rows, none, twice):
    labels = spark.createDataFrame([(d, int(k % 2)) for k, (d, _) in enumerate(rows)] + [(0, None), (None, 1), (3, 1), (3, 0)], "doc_id long, label int")
    model = module.train(docs, labels)
    got = {r.doc_id: r.score for r in module.scored(docs, model).collect()}
    assert set(got) == {d for d, _ in rows} and all(0 <= s <= 1 for s in got.values())
    assert got[1001] == got[1002]
    again = module.train(docs, labels)
    assert {r.doc_id: r.score for r in module.scored(docs, again).collect()} == pytest.approx(got)
    assert module.train(docs, labels.where("label = 1")) is None and module.train(none, labels) is None and module.train(docs, labels.limit(0)) is None
    assert {r.score for r in module.scored(docs, None).collect()} == {0.5}
    assert module.scored(none, model).count() == 0 and module.scored(twice, model).count() == twice.count()


def test_swaps_do_not_move_the_score(spark):
    rng = random.Random(4)
    filler = [f"word{k}x" for k in range(60)]
    rows = []
    for k in range(600):
        words = rng.sample(filler, 12)
        toxic = k % 4 == 0
        if toxic:
            words[3] = "scumbag"
        if rng.random() < (0.8 if toxic else 0.05):  # named mostly in toxic texts
            words[5] = "muslim"
        elif rng.random() < 0.3:
            words[5] = "christian"
        rows.append((k, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    tests = spark.createDataFrame([(1, "word1x word2x muslim word4x"), (2, "word1x word2x christian word4x"), (3, "word1x word2x word4x"), (4, "you scumbag")], "doc_id long, text string")

    def gap(penalty):
        model = toxicity.train(docs, docs.select("doc_id", "label"), penalty=penalty)
        s = {r.doc_id: math.log(r.score / (1 - r.score)) for r in toxicity.scored(tests, model).collect()}
        assert s[4] > 0 > s[3]
        return max(abs(s[1] - s[2]), abs(s[1] - s[3]))

    assert gap(50.0) < 0.25 * gap(0.0)


def brute_scores(rows):
    tokens = {d: [*re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)), "\n"] for d, t, _ in rows}
    one, two, ahead = Counter(), Counter(), Counter()
    for d, _, learn in rows:
        if learn:
            one.update(tokens[d])
            two.update(zip(["\n", *tokens[d]], tokens[d]))
    return tokens, one, two


def test_language_model(spark, docs, rows):
    marked = docs.withColumn("training", F.col("doc_id") % 4 != 0)
    got = {r.doc_id: r for r in interpolation.scored(marked).collect()}
    tokens, one, two = brute_scores([(d, t, d % 4 != 0) for d, t in rows])
    n, v = sum(one.values()), len(one)
    # The weights by plain EM over every token with itself deleted.
    seen = Counter()
    for d, words in tokens.items():
        if d % 4:
            for before, word in zip(["\n", *words], words):
                c = one[before]
                p2 = (two[before, word] - 1) / (c - 1) if c > 1 else 0.0
                seen[int(math.log2(c + 1)), p2, (one[word] - 1) / (n - 1)] += 1
    weight = {b: [0.4, 0.5, 0.1] for b, _, _ in seen}
    for _ in range(interpolation.ROUNDS):
        total = {b: [0.04, 0.05, 0.01] for b in weight}
        for (b, p2, p1), k in seen.items():
            share = [w * p for w, p in zip(weight[b], (p2, p1, 1 / (v + 1)))]
            for j in range(3):
                total[b][j] += k * share[j] / sum(share)
        weight = {b: [x / sum(t) for x in t] for b, t in total.items()}
    better = 0.0
    for d, words in tokens.items():
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in words)
        score = 0.0
        for before, word in zip(["\n", *words], words):
            c = one[before]
            w = weight.get(int(math.log2(c + 1)), [0.4, 0.5, 0.1])
            if not c:
                w = [0, w[1] / (w[1] + w[2]), w[2] / (w[1] + w[2])]
            score += math.log10(w[0] * (two[before, word] / c if c else 0) + w[1] * one[word] / n + w[2] / (v + 1))
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(one[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=0.02, abs=0.05)  # the grid rounds what EM sees
        better += r.score - r.base_score
    assert better > 0


def test_language_model_odd_tables(spark, none, twice):
    assert interpolation.scored(none.withColumn("training", F.lit(True))).count() == 0
    got = interpolation.scored(twice.withColumn("training", F.lit(False))).collect()
    assert len(got) == twice.count() and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in got)


def test_probabilities_sum_to_one_over_the_vocabulary():
    weight = interpolation.learned_weights(np.array([0, 5]), np.array([3.0, 4.0]), 10)
    assert np.allclose(weight.sum(axis=1), 1) and (weight > 0).all()


LONG = "A paragraph with some text, more text, and a good deal of sentences. It goes on for a while, as articles do. "


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""), ("", ""), ("no markup &amp; all", "no markup & all"), ("<p>Sh is.</p>", "Sh is."), ("<article><p>abc def.<script>var x='<p>no</p>'", "abc def."),
        (f"<nav><ul><li><a href=x>Home</a></ul></nav><article><h1>T &lt;b&gt;</h1><p>{LONG}<br>\n two<p>short</article><footer>&copy; all</footer>", f"T <b>\n{LONG}two\nshort"),
        (f"<div class=story><div>Head</div><div>{LONG}</div><div>end.</div></div><div class='comments'><div>{LONG}</div></div><div id=footer>legal, text.</div>", f"Head\n{LONG.strip()}\nend."),
        (f"<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>{LONG}</p><aside>side</aside><form>name <input></form><section id=comments><p>{LONG}</p></section></main>", f"T\n{LONG.strip()}"),
        ("<div>a<!-- <p>x</p> -->b</div><style>p{}</style><!-- open <p>never</p>", "ab"),
        (f"<div class='notice'>{LONG}</div><article><p>hi there.</p></article>", "hi there."),
    ],
)
def test_page_text(html, want):
    assert html_text.main_text(html or "") == want


STORY = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"
STORY_TEXT = f"T\n{LONG.strip()}\n{LONG.strip()}"


@pytest.mark.parametrize(
    "html",
    [
        f"<div class='content-sidebar-wrap'><article>{STORY}</article><div class='sidebar'>{LONG}</div></div>",
        f"<div class='no-sidebar'><div class='story'>{STORY}</div></div><div class='site-footer'>legal, text.</div>",
        f"<div class='post has-comments'><main>{STORY}</main></div><div id='comments'><article><p>{LONG * 9}</p></article></div>",
        f"<form id='aspnetForm'><div class='menu'>menu.</div><article class='post has-ads'><div class='entry no-share'>{STORY}</div></article></form>",
        f"<article><header class='entry-header'><h1>T</h1></header><p>{LONG}</p><p>{LONG}</p><div class='share-buttons'>Share this.</div></article>",
        f"<article><div class='article-header'><h1>T</h1></div><p>{LONG}</p><p>{LONG}</p><div class='related'>{LONG}</div></article>",
        f"<div class='sidebar'><article>{STORY}</article></div>",
        f"<article>{STORY}</article><div class='comments'><article><p>{LONG * 9}</p></article></div><div class='related-posts'><article><p>{LONG}</p></article></div>",
        f"<div class='story'>{STORY}</div><div class='comments'><article><p>{LONG}</p></article></div>",
    ],
)
def test_wrappers_with_side_words(html):
    assert html_text.main_text(f"<body class='has-sidebar'>{html}</body>") == STORY_TEXT


@pytest.mark.parametrize(
    "html, want",
    [
        ("<p>One<svg class='icon'/> two.</p><math /><p>Three.</p>", "One two.\nThree."),
        ("<p>One <video src=x/></p><p>Two <iframe src='y' /> three.</p><script src='z'/><p>Four.</p>", "One\nTwo three.\nFour."),
        *[(f"<div><p>One.</p><p><{t} data-x=y>lost</p><p>Two.</p></div><p>Three <{t}>lost</{t}>.</p>", "One.\nTwo.\nThree .") for t in ("object", "video", "audio", "select", "noscript", "svg", "iframe")],
        ("<div><p>One.</p><select><option>a<option>b</div><p>Two.</p>", "One.\nTwo."),
        ("<article><p>One.</p><object data=x><param name=y><b>lost</b><p>Two.</p></article>", "One.\nTwo."),
        ("<p>One <noscript><p>lost</p><svg><svg></svg></svg></noscript>two.</p><p>Three <video src=a><svg><p>x</p></svg></p>", "One two.\nThree"),
        ("<head><title>lost</head><body><p>One.</p><svg><title>lost</title></svg></body>", "One."),
        ("<title>a <!-- b</title><p>One.</p><textarea><p>never</p>", "One."),
        ("<p>One.</p><script src=/a/>lost</script><p>Two.</p><style>never<p>never</p>", "One.\nTwo."),
    ],
)
def test_elements_without_text(html, want):
    assert html_text.main_text(html) == want


PARAGRAPH = "One of the paragraphs, " + "with rather many words in it " * 13 + "and marks, as these: yes, no, so. "
LINKED = "<ul><li><a href=a>Linked one</a></li><li><a href=b>Linked two</a></li><li><a href=c>Linked three</a></li></ul>"
MENU = "<div class='top'><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></div>"


@pytest.mark.parametrize(
    "html, want",
    [
        (
            f"{MENU}<div class=story><section><h2>First</h2><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></section><section><h2>Then some more</h2><p>{PARAGRAPH}</p><ul><li>item</ul><p>Short.</p></section></div>",
            ["First", PARAGRAPH, PARAGRAPH, "Then some more", PARAGRAPH, "item", "Short."],
        ),
        (
            f"{MENU}<section><h2>First</h2>{f'<p>{PARAGRAPH}</p>' * 2}</section><section><h2>Then some more</h2><p>{PARAGRAPH}</p><ul><li>item</ul></section>",
            ["First", PARAGRAPH, PARAGRAPH, "Then some more", PARAGRAPH, "item"],
        ),
        (
            f"{MENU}<section><h2>First</h2>{f'<p>{PARAGRAPH}</p>' * 12}</section>{MENU}<section><h2>Then some more</h2><p>{PARAGRAPH}</p><ul><li>item</ul></section>{MENU}",
            ["First", *[PARAGRAPH] * 12, "Then some more", PARAGRAPH, "item"],
        ),
        (f"{MENU}<div class=page><h1>The title</h1><div class=by>By X.</div><div class=story>{f'<p>{PARAGRAPH}</p>' * 3}</div></div>", ["The title", "By X.", *[PARAGRAPH] * 3]),
        (f"{MENU}<div class=title>The title</div><div class=story>{f'<p>{PARAGRAPH}</p>' * 3}</div><div class=legal>Legal.</div>", ["The title", *[PARAGRAPH] * 3]),
        (f"{MENU}<article><h1>T</h1>{f'<p>{PARAGRAPH}</p>' * 2}{LINKED}</article>{LINKED}", ["T", PARAGRAPH, PARAGRAPH, "Linked one", "Linked two", "Linked three"]),
        (f"{MENU}<div class=story><h1>T</h1><p>{PARAGRAPH}</p>{LINKED}<p>{PARAGRAPH}</p></div>{LINKED}", ["T", PARAGRAPH, "Linked one", "Linked two", "Linked three", PARAGRAPH]),
        (f"{MENU}<h1>T</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><p class=by>By X.</p>{MENU}", ["T", PARAGRAPH, PARAGRAPH, "By X."]),
        (LINKED, []),
    ],
)
def test_articles_in_parts(html, want):
    want = "\n".join(w.strip() for w in want)
    assert html_text.main_text(html) == want
    assert html_text.main_text(f"<html><head><title>t</title></head><body>{html}</body></html>") == want


def test_many_unclosed_elements_take_linear_time():
    begun = time.process_time()
    assert html_text.main_text("<svg><p>a.</p>" * 20_000 + "</svg>")
    html_text.main_text("<svg>" * 50_000 + "</svg><p>a.</p>")
    assert time.process_time() - begun < 20


def test_pages_frame(spark):
    pages = spark.createDataFrame([(1, "u", "<p>é &eacute;</p>"), (1, "u", "<p>é &eacute;</p>"), (2, None, None), (None, "v", "")], "page_id long, url string, html string")
    got = sorted([tuple(r) for r in html_text.extracted(pages.withColumn("text", F.lit("clash"))).collect()], key=str)
    assert got == sorted([(1, "u", "é é", 3), (1, "u", "é é", 3), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_given_pages(spark):
    """The test pages have their article between <article> tags; <h1> and <p> open blocks."""
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in QUERIES["op10_html_text"](spark, FOLDER).collect():
        body = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [re.sub(r"\s+", " ", unescape(re.sub("<[^>]*>", "", p.replace("<br>", " ")))).strip() for p in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, states = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.written(stage(spark, before, FOLDER), "t")
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        states[name] = (before, after)
        before = after
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    first, last = states["quality classifier"]
    gone = ids(first) - ids(last)
    assert gone and all(labels.get(d, 0) == 0 for d in gone)
    assert not [d for d in ids(last) if labels.get(d) == 0 and zlib.crc32(str(d).encode()) % 5]
    first, last = states["n-gram Jaccard join"]
    from near_copies_brute import components_of, pairs_of, without_repeats

    _, want = components_of([(r.doc_id, r.text) for r in first.collect()])
    assert ids(last) == {d for d, c in want.items() if d == c}
    first, last = states["suffix-array dedup"]
    want = without_repeats([(r.doc_id, r.text) for r in first.collect()])
    assert {(r.doc_id, len(r.text), r.n_chars) for r in last.collect()} == {(r.doc_id, r.n_chars, r.n_chars) for r in last.collect()}
    assert ids(last) == {d for d, *_ in want} and sum(len(r.text.encode()) for r in last.collect()) <= sum(n - m for _, n, m, *_ in want)
    first, last = states["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert ids(last) == ids(first) - {d for d, _ in pairs_of([(r.doc_id, r.text) for r in first.collect()], items)}
    packed = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    assert ids(packed) == ids(before)


def test_pipeline_stages_on_odd_tables(spark, docs, none, twice):
    import corpus_pipeline

    for frame in (docs, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, FOLDER).columns == frame.columns
        corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count()
    kept = corpus_pipeline.repeats_stage(spark, docs, FOLDER).collect()
    assert {r.unit for r in kept} == {1} and {r.rest for r in kept} == {4}


def test_pipeline_delivers_ids(spark, docs):
    import corpus_pipeline

    from tallyhouse.llm.queries import tokenizer_file
    from tallyhouse.llm.tokenizing import encoder

    encode = encoder(tokenizer_file("byte_bpe_50k.json")).document
    whole = {}
    for r in sorted(corpus_pipeline.packing_stage(spark, docs, FOLDER).collect(), key=lambda r: r.start):
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        whole[r.doc_id] = whole.get(r.doc_id, b"") + r.ids
    assert whole == {r.doc_id: encode(r.text or "") for r in docs.collect()}


def test_scratch_tables_of_a_stage_go_when_the_next_begins(spark, docs):
    import os

    import corpus_pipeline

    begun = common.scratch_mark()
    kept = common.written(corpus_pipeline.repeats_stage(spark, docs, FOLDER), "kept")
    made = [p.removeprefix("file:") for p in common._scratch[begun:]]
    assert all(os.path.exists(p) for p in made) and len(made) > 1
    corpus_pipeline.quality_stage(spark, kept, FOLDER)
    assert [os.path.exists(p) for p in made] == [False] * (len(made) - 1) + [True]


def test_nothing_inside_an_article_is_dropped():
    """Short items beside very long paragraphs, and formulas."""
    long = "Paragraph with words, marks and more. " * 60
    page = f"<html><body><nav><a href=x>Menu</a></nav><article><p>{long}</p><h2>A b</h2><ul><li>a</li><li>b</li><li>c</li><li>d</li></ul><p>{long}</p></article><footer>f</footer></body></html>"
    assert html_text.main_text(page).split("\n") == [long.strip(), "A b", "a", "b", "c", "d", long.strip()]
    page = f"<html><body><article><p>{long * 32}</p><div>Yes</div><ul><li>Tea</li><li>Ham</li></ul></article></body></html>"
    assert html_text.main_text(page).split("\n")[1:] == ["Yes", "Tea", "Ham"]
    page = f"<article><p>{long}</p><p>where <math>x=<mn>3</mn><annotation encoding='t'>x=3</annotation></math> holds.</p></article>"
    assert html_text.main_text(page).split("\n")[1] == "where x=3 holds."
