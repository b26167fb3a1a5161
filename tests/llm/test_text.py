"""Packing, mixing, main text, language-model scores, quality and edit-aware counts."""

import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from farfield.llm import edit_counts, html_text, lm_score, mixing, packing, quality
from farfield.llm.blocks import make_blocks
from farfield.llm.html_text import extract_pages, main_text
from farfield.llm.quality import features, fit, judge
from farfield.llm.token_ids import WordIds

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_ids_are_the_tokenizers():
    ids = WordIds(packing.tokenizer_path())
    rng = random.Random(1)
    parts = ["a", "B", " ", "\n", "'", "'s", "'LL", "1", "22", "!", "?? ", " don't", "é", "É", "日", "\x1c", "ﬁ", "́", "İ", "Σ", "<|endoftext|>", "²", "ª", "_", "-"]
    texts = ["".join(rng.choice(parts[: 14 if k % 2 else None]) for _ in range(rng.randint(0, 30))) for k in range(1500)]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in ids.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(ids(texts)) == want


def test_packing(awkward, nothing):
    got = packing.pack(awkward, capacity=64).collect()
    tokenizer = WordIds(packing.tokenizer_path()).tokenizer
    want = Counter()
    for r in awkward.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k in range(0, len(ids), 64):
            want[r["doc_id"], k // 64, k, len(ids[k : k + 64]), crc32(ids[k : k + 64].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= math.ceil(sum(r["length"] for r in got) / 64) * 1.02
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_fullest_is_the_fullest(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(6)}
    room, sums = rng.randint(20, 90), {0}
    for k, n in counts.items():
        sums = {s + k * i for s in sums for i in range(n + 1)}
    found = packing.fullest(counts, room)
    assert sum(k * n for k, n in found.items()) == max(s for s in sums if s <= room) and all(n <= counts[k] for k, n in found.items())


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights, total = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values())
    out, open_ = dict.fromkeys(order, 0.0), set(order)
    while True:
        rest = total - sum(out[s] for s in order if s not in open_)
        shares = {s: rest * weights[s] / sum(weights[o] for o in open_) for s in open_}
        above = {s for s in open_ if shares[s] > 2 * sizes[s]}
        if not above:
            return out | shares
        for s in above:
            out[s] = 2.0 * sizes[s]
        open_ -= above


def test_mix(awkward, nothing):
    got = mixing.mix_sources(awkward, block_words=16).collect()
    assert len(got) == awkward.count()
    rows = [(r["doc_id"], len(WORD.findall(r["text"] or "")), r["source"]) for r in awkward.collect()]
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n) for i, n, _ in rows)
    sizes = Counter()
    for _, n, s in rows:
        sizes[s] += n
    want = brute_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["target"]] += r["taken"]
    assert sorted(taken) == pytest.approx(sorted(want.values()))
    assert all(abs(n - t) <= 17 for t, n in taken.items())
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_sources(awkward.repartition(5), block_words=16).collect()))
    assert mixing.mix_sources(nothing).count() == 0


def test_mixed_documents_hold_what_is_taken(awkward):
    taken, words = Counter(), Counter()
    for r in mixing.mix_sources(awkward, block_words=16).collect():
        taken[r["doc_id"]] += r["taken"]
    mixed = mixing.mixed_documents(awkward, block_words=16)
    for r in mixed.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert +taken == +words and mixed.columns == awkward.columns


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 12, 97, 1000])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), *mixing.grid(F.lit(n)), F.lit(3))).collect()]
    assert sorted(got) == list(range(n))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/>home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy &amp; save</div>%s
<aside>see also</aside><div id="comments"><p>first!</p></div><form><p>Your mail</p><input></form><footer>&copy; x</footer></body></html>"""


def test_main_text():
    article = "<article><h1>Head  line</h1><p><b>One&nbsp;&lt;two&gt;<br>three<p>Four\n five</p><!-- no --><div class='share-buttons'>tweet</div><p>Six</p></article>"
    assert main_text(PAGE % article) == "Head line\nOne <two> three\nFour five\nSix"
    body = "<div><p>" + "A long paragraph of running text that says something. " * 4 + "</p><p>" + "Another one that goes on for a while as well, with words. " * 3 + "</p></div>"
    assert main_text(PAGE % body).split("\n") == [("A long paragraph of running text that says something. " * 4).strip(), ("Another one that goes on for a while as well, with words. " * 3).strip()]
    assert main_text("") == "" and main_text("<script>x</script>") == ""


def test_article_is_only_evidence():
    body = [f"Paragraph {k} of the body says something at some length, as paragraphs do. " * 3 for k in range(5)]
    paragraphs = "".join(f"<p>{b}</p>" for b in body)
    for page in (f"<div>{paragraphs}</div><article><h3>Teaser</h3></article>", f"<main><p>Teaser</p></main><div>{paragraphs}</div>"):
        got = main_text(PAGE % page).split("\n")
        assert set(b.strip() for b in body) <= set(got) and "first!" not in got


ARTICLES = {
    '<div class="content no-sidebar">%s</div>': [],
    '<div class="page with-comments">%s</div>': [],
    '<div class="social-studies">%s</div>': [],
    "<form>%s</form>": [],
    "<article><header><h1>Title here</h1><p class='byline'>By Me</p></header>%s<p>x <math><mi>a</mi></math> <label>L</label></p><footer>Tags: a</footer></article>": ["Title here", "By Me", "x a L"],
    "<article><h3>Teaser</h3></article><div>%s</div>": ["Teaser"],
    "<article>%s</article><div class='comments'><p>I think so too, really, as I said before, and so do many others.</p><p>ok</p></div>": [],
    "<article>%s<section id='comments'><h3>Comments</h3><p>I think so too, really, as I said before.</p></section></article>": [],
    "<main>%s</main><div><p>Sign up now for our mail and get news</p></div>": [],
    "<div class='notice'>This site is under repair today.</div><article>%s</article>": [],
}


@pytest.mark.parametrize("page", ARTICLES)
def test_articles_in_many_frames(page):
    body = [f"Paragraph {k} of text that says a thing, and then some more. " * 3 for k in range(4)]
    frame = "<html><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>%s<aside>Side text that goes on for a bit</aside><footer>About us and all rights</footer></body></html>"
    got = main_text(frame % (page % "".join(f"<p>{b}</p>" for b in body))).split("\n")
    assert [x for x in got if x.startswith("Paragraph")] == [b.strip() for b in body]
    assert sorted(x for x in got if not x.startswith("Paragraph")) == sorted(ARTICLES[page])


def test_ratios_decide(monkeypatch):
    """Without the threshold of the ratios, menus come along."""
    page = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><article><h1>One</h1><p>A paragraph of text.</p></article>"
    assert main_text(page) == "One\nA paragraph of text."
    monkeypatch.setattr(html_text, "THRESHOLD", 0.0)
    assert "Home" in main_text(page)


def test_scores_by_the_formula():
    """Smoothed log ratios and the threshold, computed by hand for a page without marks."""
    lengths = [3, 40, 400, 2, 90, 0, 5, 900, 12, 1]
    ratio = [math.log1p(n / 2) for n in lengths if n]  # one tag opens and closes each: the end falls to the next block
    kernel = [math.exp(-(k**2) / 2) for k in range(-3, 4)]
    padded = [ratio[0]] * 3 + ratio + [ratio[-1]] * 3
    smooth = [sum(w * padded[i + k] for k, w in enumerate(kernel)) / sum(kernel) for i in range(len(ratio))]
    assert np.allclose(html_text.smoothed(np.array(ratio)), smooth)
    ordered = sorted(smooth)
    middle = next(v for i, v in enumerate(ordered) if sum(ordered[: i + 1]) >= sum(ordered) / 2)
    assert html_text.typical(np.array(smooth)) == pytest.approx(middle)


def test_pages_without_rows_and_very_long_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert extract_pages(empty).collect() == []
    blocks = [f"Block number {k} says something of some length here." for k in range(20_000)]
    got = extract_pages(spark.createDataFrame([(1, "u", "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>")], "page_id long, url string, html string")).first()
    assert got["text"].split("\n") == blocks


def test_one_long_block_drops_no_others():
    short = [f"{k} says a few things. " * 9 for k in range(50)]
    page = "".join(f"<p>{b}</p>" for b in [*short[:25], "Very long text. " * 6250, *short[25:]])
    assert main_text(PAGE % f"<div>{page}</div>").split("\n") == [b.strip() for b in [*short[:25], "Very long text. " * 6250, *short[25:]]]


def test_links_of_the_text_stay():
    links = [f"<a href=/{k}>Entry number {k}</a>" for k in range(12)]
    text = "A long paragraph of running text that says something. " * 8
    page = f"<p>{text}</p><ul>{''.join(f'<li>{x}</li>' for x in links)}</ul><p>{text}</p>"
    assert main_text(PAGE % f"<article>{page}</article>").split("\n") == [text.strip(), *(f"Entry number {k}" for k in range(12)), text.strip()]
    assert main_text(PAGE % f"<div><p>{text}</p><p>{links[0]}</p><p>{text}</p></div>").split("\n") == [text.strip(), "Entry number 0", text.strip()]


MARKED = ["overflow-hidden", "no-sidebar", "with-sidebar", "elementor-widget", "page-header-layout", "widget", "content form"]


@pytest.mark.parametrize("name", MARKED)
def test_marks_are_only_evidence(name):
    body = [f"Paragraph {k} of the body says something at some length. " * (1 + k) for k in range(4)]
    want = [b.strip() for b in body]
    paragraphs = "".join(f"<p>{b}</p>" for b in body)
    for page in (
        f"<div class='{name}'><article>{paragraphs}</article></div>",
        f"<div class='{name}'><main><div id='{name}'>{paragraphs}</div></main></div>",
        f"<div class='{name}'>{paragraphs}</div>",
        "".join(f"<div class='{name}'><p>{b}</p></div>" for b in body),
        f"<div class='{name}'>{paragraphs}</div><article></article>",
    ):
        assert main_text(PAGE % page).split("\n") == want, page
    assert main_text(PAGE % f"<div class='{name}'>{paragraphs}</div><article>Teaser</article>").split("\n") == [*want, "Teaser"]
    # a mark of a small part still counts
    assert main_text(PAGE % f"<article>{paragraphs}<div class='related'>See more</div></article>").split("\n") == want
    # and within a line, words stay together
    line = "<article><p>One <span class='no-widget'>two</span> three<span class='hidden'>x</span> four</p></article>"
    assert main_text(PAGE % line) == "One two three four"


def test_pages(spark):
    rows = [(1, "u", PAGE % "<article><p>Text</p></article>", 5), (2, None, None, 5), (None, "v", "", 5), (1, "u", PAGE % "<article><p>Text</p></article>", 5)]
    got = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "Text", 4), (1, "u", "Text", 4), (2, None, "", 0), (None, "v", "", 0)], key=str)


def test_base_scores(awkward, nothing):
    got = lm_score.lm_scores(awkward).collect()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = lambda r: [*WORD.findall((r["text"] or "").translate(low)), "\0end"]
    held = lambda r: crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 10 == 0
    counts = Counter(t for r in awkward.collect() if not held(r) for t in tokens(r))
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in awkward.collect():
        ts = tokens(r)
        want.append((str(r["doc_id"]), held(r), len(ts), sum(counts[t] > 0 for t in ts), n, round(sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), 6)))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == sorted(want)
    assert all(r["score"] < 0 for r in got) and lm_score.lm_scores(nothing).count() == 0


def test_probabilities_sum_to_one():
    """After any context, seen or not, the model's 256 probabilities sum to one."""
    rng = np.random.default_rng(2)
    text = bytes(rng.choice([97, 98, 99, 32], 400, p=[0.4, 0.3, 0.1, 0.2]).tolist())
    seen = Counter(int.from_bytes(text[i - lm_score.ORDER : i + 1], "big") for i in range(lm_score.ORDER, len(text)))
    pairs = np.zeros((256, 256), dtype=np.int64)
    for code, n in seen.items():
        pairs[code >> 8 & 255, code & 255] += n
    for context in (text[10:15], b"zzabc", b"aaaaz", b"ab ca"):
        asked = {int.from_bytes(context + bytes([s]), "big") for s in range(256)}
        codes = np.array(sorted(seen.keys() | asked), dtype=np.uint64)
        logp = lm_score.log_probabilities(codes, np.array([seen[int(c)] for c in codes]), lm_score.Suffixes(pairs))
        assert abs(sum(10 ** p for c, p in zip(codes.tolist(), logp, strict=True) if c in asked) - 1) < 1e-9


class Trie:
    """The model by the book: of each context of up to ORDER bytes, how often each byte follows it."""

    def __init__(self, texts):
        self.after = {}
        for t in texts:
            for k in range(lm_score.ORDER, len(t)):
                for n in range(lm_score.ORDER + 1):
                    self.after.setdefault(t[k - n : k], Counter())[t[k]] += 1

    def log10(self, t):
        total = 0.0
        for k in range(lm_score.ORDER, len(t)):
            excluded, found = set(), False
            for n in range(lm_score.ORDER, -1, -1):
                here = {s: c for s, c in self.after.get(t[k - n : k], {}).items() if s not in excluded}
                if here and not found:
                    whole = sum(here.values()) + len(here)
                    found = t[k] in here
                    total += math.log10((here[t[k]] if found else len(here)) / whole)
                    excluded |= set(here)
            total -= 0 if found else math.log10(max(1, 256 - len(excluded)))
        return total


@pytest.mark.parametrize(("hot", "rows"), [(lm_score.HOT, lm_score.MODEL_ROWS), (20, 300)])
def test_scores_are_those_of_a_plain_trie(spark, awkward, monkeypatch, hot, rows):
    """Whole documents, with all grams of a pair in one task, and with pairs split by the third byte."""
    monkeypatch.setattr(lm_score.model, "__defaults__", (hot, rows))
    monkeypatch.setattr(lm_score, "make_blocks", lambda d, i, t, size=3000: make_blocks(d, i, t, size))
    stream = lambda r: lm_score.PAD + b" ".join((r["text"] or "").encode().lower().split()) + b"\0"
    held = lambda r: crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 10 == 0
    docs = awkward.where("length(text) < 3000 or text is null")
    every = docs.collect()
    trie = Trie([stream(r) for r in every if not held(r)])
    want = sorted((str(r["doc_id"]), round(trie.log10(stream(r)), 8)) for r in every)
    assert sorted((str(r["doc_id"]), round(r["score"], 8)) for r in lm_score.lm_scores(docs).collect()) == want


def test_quality(spark, nothing):
    rng = random.Random(3)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    good = lambda: " ".join(rng.choice(words) for _ in range(60)).capitalize() + "."
    junk = lambda: " ".join(rng.choice(words).upper() + "!!" for _ in range(40))
    rows = [(i, junk() if i % 4 == 0 else good(), "en", f"s{i % 5}") for i in range(400)] + [(None, None, None, None), (7, good(), "en", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = [r for r in judge(docs, labels).collect() if r["doc_id"] is not None and r["doc_id"] >= 200]
    assert all(r["kept"] == (r["doc_id"] % 4 != 0) for r in got)
    assert judge(docs, labels).count() == len(rows) and judge(nothing, labels).count() == 0 and judge(docs, labels.limit(0)).count() == len(rows)


def test_words_matter_and_held_out_labels_are_met():
    """Texts that only their words tell apart: labels of documents that weren't seen are met at 0.98 or more."""
    rng = random.Random(8)
    good, bad = (["".join(rng.choice("aeioulmnrst") for _ in range(6)) for _ in range(60)] for _ in range(2))
    texts = [" ".join(rng.choice(good if k % 2 else bad) for _ in range(80)).encode() for k in range(600)]
    rows = np.array([features(t) for t in texts])
    w, b, _ = fit(rows[:300], np.array([k % 2 for k in range(300)], dtype=float))
    assert ((rows[300:] @ w + b > 0) == [k % 2 == 1 for k in range(300)]).mean() >= 0.98


def test_posteriors_are_those_of_the_formula(spark, awkward):
    """Sites' means, shrunk by the spread of the sites, and documents' posteriors, computed row by row from the evidence."""
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(40)], "doc_id long, quality int")
    docs = awkward.unionByName(awkward.where("doc_id = 3").selectExpr("doc_id", "text", "'fr' AS lang", "'s9' AS source", "n_chars", "h", "part", "id"))
    got = judge(docs, labels).collect()
    model = quality.train(docs, labels)
    odds = lambda e: 1 / (1 + math.exp(-(e + model[2])))
    rows = [(r["doc_id"], r["source"], r["lang"], float(features((r["text"] or "").encode()) @ model[0]) + model[1] - model[2]) for r in docs.collect()]
    overall = min(1 - 1e-6, max(1e-6, sum(odds(e) for *_, e in rows) / len(rows)))

    def strength(sites):
        k, n = len(sites), sum(map(len, sites.values()))
        if k < 2:
            return 1e3
        between = sum(len(v) * (sum(v) / len(v) - overall) ** 2 for v in sites.values()) / n
        noise = k * sum(p * (1 - p) for v in sites.values() for p in v) / n / n
        return min(1e4, max(1.0, overall * (1 - overall) / max(1e-6, between - noise) - 1))

    hosts, paths = defaultdict(list), defaultdict(list)
    for _, h, p, e in rows:
        hosts[h].append(odds(e))
        paths[h, p].append(odds(e))
    a, b = strength(hosts), strength(paths)
    host = {h: (sum(v) + a * overall) / (len(v) + a) for h, v in hosts.items()}
    path = {k: (sum(v) + b * host[k[0]]) / (len(v) + b) for k, v in paths.items()}
    logit = lambda p: math.log(p / (1 - p))
    want = []
    for i, h, p, e in rows:
        site = max(-quality.SITE_LOGIT, min(quality.SITE_LOGIT, logit(path[h, p]) - logit(overall)))
        q = 1 / (1 + math.exp(-(e + model[2] + site)))
        want.append((str(i), round(e, 4), round(host[h], 6), round(path[h, p], 6), round(q, 6)))
    assert sorted((str(r["doc_id"]), round(r["evidence"], 4), round(r["host_mean"], 6), round(r["path_mean"], 6), round(r["quality"], 6)) for r in got) == sorted(want)
    assert all(r["kept"] == (r["quality"] >= 0.5) for r in got)


def test_rejected_rows_go_alone(spark, monkeypatch):
    """Of rows that agree in id and text, only that of the rejected site goes."""
    docs = spark.createDataFrame([(1, "t", "en", "a"), (1, "t", "en", "b"), (1, "t", None, None), (2, None, "en", "a")], "doc_id long, text string, lang string, source string")
    known = judge(docs, spark.createDataFrame([], "doc_id long, quality int"))
    host = F.xxhash64(F.lit("hb"), F.lit("hen"))
    monkeypatch.setattr(quality, "judge", lambda *a: known.withColumn("kept", F.col("site_hash") != host))
    assert sorted(map(str, quality.without_rejected(docs, docs).collect())) == sorted(map(str, docs.where("source is null or source <> 'b'").collect()))


def test_fit_separates():
    rows = np.array([features(t) for t in (b"plain words here", b"A!! B!! C!!", b"more plain words", b"X!! Y!!")], dtype=np.float32)
    w, b, _ = fit(rows, np.array([1.0, 0, 1, 0]))
    assert ((rows @ w + b > 0) == [True, False, True, False]).all()


def test_edits_keep_counts():
    counter = edit_counts.Counter(edit_counts.vocabulary_path())
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "'", "'s", "re", "ll", "1", "22", "!", "?? ", " the", " don't", "é", "日", "\x1c", " "]
    for k in range(1500):
        text = "".join(rng.choice(parts[:-3] if k % 2 else parts) for _ in range(rng.randint(0, 25)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(0, 4))))
        edits = [(cuts[i], cuts[i + 1], "".join(rng.choice(parts) for _ in range(rng.randint(0, 3)))) for i in range(0, len(cuts) - 1, 2)]
        tree = edit_counts.PretokenTree(text, counter)
        assert tree.total == len(counter.encoding.encode_ordinary(text))
        edited, redone = tree.apply(edits)
        assert tree.total == len(counter.encoding.encode_ordinary(edited)) == tree.levels[0].sum()
        assert bool(edits) or not redone


def test_only_the_region_is_encoded_again():
    counter = edit_counts.Counter(edit_counts.vocabulary_path())
    text = "plain words " * 200 + "mail me at some.one@example.com now " + "plain words " * 200
    tree = edit_counts.PretokenTree(text, counter)
    _, redone = tree.apply(edit_counts.mask_edits(text))
    assert 0 < redone < 10 < tree.n


def apply_edits(text, edits):
    for start, end, new in sorted(edits, reverse=True):
        text = text[:start] + new + text[end:]
    return text


def test_edit_counts_of_awkward_rows(awkward, nothing):
    encoding = edit_counts.Counter(edit_counts.vocabulary_path()).encoding
    got = edit_counts.edit_counts(awkward).collect()
    edited = lambda t: "".join(c for c in apply_edits(t, edit_counts.mask_edits(t)))
    assert Counter((r["doc_id"], r["n_edits"], r["n_tokens_edited"]) for r in got) == Counter((r["doc_id"], len(edit_counts.mask_edits(r["text"] or "")), len(encoding.encode_ordinary(edited(r["text"] or "")))) for r in awkward.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((r["doc_id"], len(encoding.encode_ordinary(r["text"] or ""))) for r in awkward.collect())
    assert edit_counts.edit_counts(nothing).count() == 0
