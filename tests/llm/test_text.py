"""Extraction, language identification and language-model scores."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import html_text, language_id, lm_score
from tidemark.llm.stage import Run

ARTICLE = "<h1>Title</h1><p>One, two. Three &amp; <b>four</b>;</p><ul><li>first item</li><li>second</li></ul><p>Last   line.\n</p>"
TEXT = "Title One, two. Three & four; first item second Last line."
AROUND = '<nav><a href="/x">Menu, one.</a></nav><header>Site header</header>{}<aside>Side text, long. And longer, too.</aside><footer>&copy; us</footer>'


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        (" \n", ""),
        ("<html><body></body></html>", ""),
        ("plain words, no tags.", "plain words, no tags."),
        (f"<html><head><title>T</title></head><body>{AROUND.format(f'<article>{ARTICLE}</article>')}</body></html>", TEXT),
        (f"<body>{AROUND.format(f'<div id=content>{ARTICLE}</div>')}<div class='user-comments'><p>Me, too. I agree, wholly.</p></div></body>", TEXT),
        (f"<main>{ARTICLE}<section id=\"comments\"><p>Nice, thanks.</p></section><form><p>Mail: <input></p></form></main>", TEXT),
        ("<article><p>a<br>b<p>c <i>d</i>e</article>", "a b c de"),
        ("<article><p><b>bold<br><p>next &lt;tag&gt; &#233;&eacute;</p></article>", "bold next <tag> éé"),
        ("<article><p>x</p><script>if (a < b) { '</p>' }</script><style>p{}</style><!-- no, <p>no</p> --><p>y", "x y"),
        ("<article><p>5 < 6 & 7 > 3</p></article>", "5 < 6 & 7 > 3"),
        ('<article><p title="a > b">q</p><p hidden>h</p><div style="display: none">z</div></article>', "q"),
        ("<ARTICLE><P>Caps</P></ARTICLE>", "Caps"),
        ('<article><a href="x>broken</a> tail.</article>', "broken tail."),
        ("<article><p>kept</p></div></span><p>too</p></article>", "kept too"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_large_and_deep_pages():
    assert html_text.main_text("<article>" + "<p>a b.</p>" * 20000) == " ".join(["a b."] * 20000)
    assert html_text.main_text("<div>" * 20000 + "x, y." + "</div>" * 9000) == "x, y."


def test_pages(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>", 1, "t"), (1, "u", f"<article>{ARTICLE}</article>", 1, "t"), (2, None, None, 2, "t"), (None, "v", "<article>é</article>", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    got = sorted(tuple(r) for r in html_text.extracted(pages).collect() if r.page_id)
    assert got == [(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0)]
    assert html_text.extracted(pages).where("page_id IS NULL").first().n_chars == 1
    assert html_text.extracted(pages.limit(0)).collect() == []


def test_slot_counts():
    """Each n-gram once, whatever the parts the text is taken in."""
    text = "Über " * 50 + "日本"
    whole = language_id.counts(text)
    assert whole.sum() == sum(len(text) + 1 - n for n in range(3)) and (language_id.counts(text.upper()) == whole).all()
    part = language_id.PART
    try:
        language_id.PART = 7
        assert (language_id.counts(text) == whole).all()
    finally:
        language_id.PART = part
    assert language_id.counts("").sum() == 1


def test_ftrl_against_loops():
    rng = np.random.default_rng(1)
    rows = [(int(rng.integers(3)), np.sort(rng.choice(40, 5, replace=False)), rng.random(5)) for _ in range(30)]
    z, n = np.zeros((41, 3)), np.zeros((41, 3))
    slot = lambda s: 40 if s == language_id.SLOTS else s

    def weight(i, c, bias):
        l1 = 0.0 if bias else language_id.L1
        if abs(z[i, c]) <= l1:
            return 0.0
        return -(z[i, c] - math.copysign(l1, z[i, c])) / ((language_id.BETA + math.sqrt(n[i, c])) / language_id.ALPHA + language_id.L2)

    for _ in range(language_id.EPOCHS):
        for label, slots, values in rows:
            items = [*zip(slots.tolist(), values), (40, 1.0)]
            w = {(i, c): weight(i, c, i == 40) for i, _ in items for c in range(3)}
            scores = [sum(x * w[i, c] for i, x in items) for c in range(3)]
            p = np.exp(scores) / np.exp(scores).sum()
            for i, x in items:
                for c in range(3):
                    g = x * (p[c] - (c == label))
                    z[i, c] += g - (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / language_id.ALPHA * w[i, c]
                    n[i, c] += g * g
    weights, bias = language_id.fit_weights(rows, 3)
    expected = [[weight(i, c, i == 40) for c in range(3)] for i in range(41)]
    assert np.allclose(weights[:40], expected[:40], atol=1e-6) and np.allclose(bias, expected[slot(language_id.SLOTS)], atol=1e-6)


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = language_id.fit(docs)
    got = language_id.predicted(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    apart = [r for r in got if r.held_out]
    assert len(got) == docs.count() and 0.2 < len(apart) / len(got) < 0.3
    assert np.mean([r.lang_pred == r.lang for r in apart]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    # Calibrated: the mean score is about the share of right answers.
    assert abs(np.mean([r.score for r in apart]) - np.mean([r.lang_pred == r.lang for r in apart])) < 0.03
    assert (model.weights == 0).mean() > 0.3


def test_language_edges(spark):
    schema = "doc_id long, text string, lang string, score string, held_out int"
    rows = [(i, ("the house is " if i % 2 else "das haus ist ") * 5, "en" if i % 2 else "de", "x", 1) for i in range(40)]
    rows += [(100, None, "en", "x", 1), (101, "", None, "x", 1), (102, "12 34 !", "de", "x", 1), (103, "the house " * 50000, None, "x", 1), (None, "das haus ist", "de", "x", 1), (1, rows[1][1], "en", "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    got = language_id.predicted(docs, language_id.fit(docs)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[103].lang_pred == by[1].lang_pred == "en" and by[None].lang_pred == "de" and not by[None].held_out
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    nothing = language_id.fit(docs.where("lang = 'no'"))
    assert {r.lang_pred for r in language_id.predicted(docs, nothing).collect()} == {"und"}
    assert language_id.predicted(docs.limit(0), nothing).collect() == []
    # Neither the language column nor held-out rows change a prediction.
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(string(doc_id)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    again = {r.doc_id: r.lang_pred for r in language_id.predicted(other, language_id.fit(other)).collect()}
    assert again == {i: r.lang_pred for i, r in by.items()}


def brute_losses(texts, targets, size):
    total = Counter(w for t in texts for w in (t or "").split())
    kept = {w: i for i, (w, _) in enumerate(sorted(total.items(), key=lambda x: (-x[1], x[0].encode()))[: size - 2], 2)}

    def counts(some):
        pairs, after, of = Counter(), Counter(), Counter()
        for t in some:
            ids = [lm_score.START, *(kept.get(w, 0) for w in (t or "").split())]
            pairs.update(zip(ids, ids[1:]))
            after.update(ids[:-1])
            of.update(ids[1:])
        return pairs, after, of

    models = counts([texts[i] for i in targets]), counts(texts)
    out = []
    for i, t in enumerate(texts):
        own, losses = counts([t]), []
        for model, inside in zip(models, (i in targets, True)):
            # What the other texts hold, and one for each word.
            pairs, after, of = (m - o if inside else m for m, o in zip(model, own))
            mass = sum(of.values()) + size - 1 + 1e-9
            losses.append(sum(-n * math.log((pairs[a, b] + lm_score.PRIOR * (of[b] + 1) / mass) / (after[a] + lm_score.PRIOR)) for (a, b), n in own[0].items()))
        words = sum(own[2].values())
        out.append([x / words if words else None for x in losses])
    return out


def test_lm_scores(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefghijklmnop" if i % 3 else "abcdxyz") * rng.choice((1, 1, 2)) for _ in range(rng.randrange(80))) for i in range(90)]
    texts += [None, "", " \n ", "a b " * 30000, "unseen words only"]
    docs = spark.createDataFrame([(i, t, 1.0, 2) for i, t in enumerate(texts)], "doc_id long, text string, score double, pair int")
    targets = list(range(0, 90, 3))
    target = spark.createDataFrame([(i, "x") for i in [*targets, 0, None, 999]], "doc_id long, text string")
    monkeypatch.setattr(lm_score, "COUNTED", 300)
    got = {r.doc_id: r for r in lm_score.scored(Run(spark, "test9"), docs, target, 20).collect()}
    expected = brute_losses(texts, targets, 20)
    assert len(got) == len(texts)
    for i, (a, b) in enumerate(expected):
        if a is None:
            assert got[i].n_tokens == 0 and got[i].score is None
        else:
            assert got[i].target_loss == pytest.approx(a, rel=1e-4) and got[i].background_loss == pytest.approx(b, rel=1e-4)
            assert got[i].score == pytest.approx(a - b, abs=1e-4)
    assert np.mean([got[i].score for i in range(90) if i % 3 == 0 and got[i].n_tokens]) < np.mean([got[i].score for i in range(90) if i % 3 and got[i].n_tokens])
    assert len(lm_score.scored(Run(spark, "test9"), docs, target.limit(0), 20).collect()) == len(texts)
    assert lm_score.scored(Run(spark, "test9"), docs.limit(0), target, 20).collect() == []


def test_lm_scores_know_every_word(spark, monkeypatch):
    """More words than any fixed vocabulary, many of them rare, with one word and one pair in all texts."""
    rng = random.Random(16)
    texts = [" ".join(["the very", *(f"w{rng.randrange(90000)}" if rng.random() < 0.7 else "the" for _ in range(rng.randrange(100)))]) for _ in range(150)]
    texts += [None, " ", "the very " * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    targets = list(range(0, 150, 4))
    target = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    monkeypatch.setattr(lm_score, "COUNTED", 500)
    distinct = len({w for t in texts for w in (t or "").split()})
    assert distinct > 4096
    expected = brute_losses(texts, targets, distinct + 2)
    # The last one: pairs that 5 texts may hold are counted in several tasks.
    for most, split in ((lm_score.BROADCAST_IDS, lm_score.SPLIT), (0, lm_score.SPLIT), (0, 5)):
        monkeypatch.setattr(lm_score, "BROADCAST_IDS", most)
        monkeypatch.setattr(lm_score, "SPLIT", split)
        got = {r.doc_id: r for r in lm_score.scored(Run(spark, "test9"), docs, target).collect()}
        assert len(got) == len(texts)
        for i, (a, b) in enumerate(expected):
            assert (got[i].target_loss, got[i].background_loss) == ((None, None) if a is None else (pytest.approx(a, rel=1e-9), pytest.approx(b, rel=1e-9)))


def test_lm_scores_of_members(spark):
    """Documents of the target score as equally written ones outside it do, others higher; copies know each other."""
    rng = random.Random(9)
    ways = [[f"{c}{i}" for i in range(400)] for c in "ab"]
    texts = [" ".join(rng.choice(ways[i % 2][: rng.choice((20, 400))]) for _ in range(60)) for i in range(400)]
    texts += [" ".join(f"own{i} {j}" for j in range(30)) for i in (1, 2, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.scored(Run(spark, "test9"), docs, docs.where("doc_id < 400 AND doc_id % 4 = 0")).collect()}
    inside, outside, other = (np.mean([got[i].score for i in range(400) if i % 4 == k]) for k in (0, 2, 1))
    assert abs(inside - outside) < 0.05 and other - outside > 1
    assert got[401].background_loss == got[402].background_loss < got[400].background_loss - 1


STORY = "<p>" + "The council met on Monday, and after a long debate it decided to build the bridge. " * 3 + "</p>"
PLAIN = ("The council met on Monday, and after a long debate it decided to build the bridge. " * 3).strip()


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><div id=story><h1>Bridge</h1>{STORY}{STORY}</div>" + "<article class=teaser><h3>Other</h3><p>Read it here.</p></article>" * 3, f"Bridge {PLAIN} {PLAIN}"),
        (f"<body><div class=content>{STORY}</div><article class='comment'><p>I agree.</p></article>", PLAIN),
        (f"<body><div class='content no-sidebar'>{STORY}</div>", PLAIN),
        (f"<body><div class='related-work'>{STORY}</div><div class='social-science'>{STORY}</div><div class='related-posts'>{STORY}</div>", f"{PLAIN} {PLAIN}"),
    ],
)
def test_ratios_decide_between_elements(page, text):
    assert html_text.main_text(page) == text


def test_ratios_against_brute_force():
    """Means per path, smoothing, fusing and threshold, on pages of which no element is named."""
    rng = random.Random(21)
    for _ in range(60):
        tags = ["".join(rng.choice("abcd") for _ in range(3)) for _ in range(rng.randrange(1, 7))]
        nodes = [(rng.choice(tags), "x" * rng.randrange(1, 200) + "." * rng.randrange(4)) for _ in range(rng.randrange(1, 30))]
        page = "".join(f"<x-{t}>{text}</x-{t}>" for t, text in nodes)
        order = list(dict.fromkeys(t for t, _ in nodes))
        of = {t: [text for u, text in nodes if u == t] for t in order}
        mean = {t: (sum(map(len, of[t])) / len(of[t]), (1 + sum(x.count(".") for x in of[t])) / len(of[t])) for t in order}
        value = {}
        for i, t in enumerate(order):
            near = [mean[u] for u in order[max(0, i - 1) : i] + order[i + 1 : i + 2]]
            smooth = [(0.5 * mean[t][k] + 0.25 * sum(n[k] for n in near)) / (0.5 + 0.25 * len(near)) for k in (0, 1)]
            value[t] = math.sqrt(smooth[0] * smooth[1])
        length = {t: sum(map(len, of[t])) for t in order}
        limit = html_text.THRESHOLD * sum(value[t] * length[t] for t in order) / sum(length.values())
        chosen = [t for t in order if value[t] >= limit]
        total = sum(length[t] for t in chosen)
        bulk = [t for t in chosen if length[t] >= html_text.MOST * total]
        expected = bulk or chosen
        assert html_text.main_text(page) == " ".join(text for t, text in nodes if t in expected)


def test_languages_without_a_cap_and_letters(spark):
    """More languages than any list has, two of them with two labelled rows, and texts without letters."""
    rows = [(i, " ".join(chr(0x4E00 + 40 * (i % 201) + k) * 3 for k in range(20)), f"l{i % 201:03d}") for i in range(201 * 6)]
    rows += [(10_000 + i, "zq zq zq " * 20, "rare") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = docs.where("lang <> 'rare' OR doc_id < 10004")
    model = language_id.fit(few)
    assert len(model.languages) == 202
    got = [model.predict(text)[0] == lang for _, text, lang in rows[:402]]
    assert sum(got) >= 0.95 * len(got) and model.predict("zq zq zq zq")[0] == "rare"
    assert [model.predict(x)[0] for x in ("½ ²", "①", "1_2", "\u0301")] == ["und"] * 4 and model.predict("ª")[0] != "und"
