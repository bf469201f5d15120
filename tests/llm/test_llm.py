"""Operators against brute force on small fixtures with NULLs, ties, repeats and hot groups."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hailscope.llm import exact_dedup, html, lattice, line_dedup, lm, packing, quality, simhash, substring, topk
from hailscope.llm.tokens import WordEncoder

LINE = "this very line stands in many of the documents"
PASSAGE = " ".join(f"w{i}" for i in range(60))
PAIRS = [
    (1, None), (2, ""), (3, "a b\nc"), (4, "ab c"), (5, "a  b c "), (5, "a  b c "), (None, "nobody"), (6, "x" * 5000),
    *((10 + i, f"{LINE}\nown {i}\n  {LINE.upper()} ") for i in range(6)),
    *((30 + i, f"head {i} {PASSAGE} tail {i}") for i in range(4)),
    (40, f"{PASSAGE} {PASSAGE}"), (41, " ".join(f"v{i}" for i in range(100))),
    (42, "été ÉTÉ 12345 it's\x0bdone"), (43, " \n\t"),
]


@pytest.fixture(scope="module")
def docs(make_docs):
    names = ("score", "mark", "key", "run", "n", "spans", "word", "rid", "hash", "anchor")
    return make_docs(PAIRS, *names)


@pytest.fixture(scope="module")
def nothing(make_docs):
    return make_docs([]).filter("false")


def test_exact_dedup(docs, nothing):
    groups = defaultdict(list)
    for i, t in PAIRS:
        groups[re.sub(r"[ \t-\r]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    want = []
    for plain, rows in groups.items():
        best = min(rows)
        digest = hashlib.sha256(plain.encode()).hexdigest()
        want += [(r[3], best[3], len(rows), r[3] == best[3] and r[0] == best[0], digest) for r in rows]
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs, fan_in=2, rounds=2).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_line_dedup(docs, nothing):
    def norm(line):
        return line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()

    holders = defaultdict(set)
    for i, t in PAIRS:
        for line in (t or "").split("\n"):
            holders[norm(line)].add(i)
    want = []
    for i, t in PAIRS:
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            k = norm(line)
            shared = len(k) >= 40 and len(holders[k]) >= 5
            if not shared or i == max((x for x in holders[k] if x is not None), default=None):
                kept.append(line)
        want.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = [tuple(r) for r in line_dedup.line_dedup(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.line_dedup(nothing).count() == 0


@pytest.mark.parametrize("hot", [0, 500])
def test_substring_dedup(docs, nothing, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_ANCHOR", hot)
    windows = Counter()
    for _, t in PAIRS:
        w = (t or "").encode().split()
        windows.update(tuple(w[k : k + 35]) for k in range(len(w) - 34))
    want = []
    for i, t in PAIRS:
        w = (t or "").encode().split()
        keep = [True] * len(w)
        for k in range(len(w) - 34):
            if windows[tuple(w[k : k + 35])] > 1:
                keep[k : k + 35] = [False] * 35
        want.append((i, b" ".join(x for x, y in zip(w, keep, strict=True) if y).decode(), len(w), keep.count(False)))
    got = [tuple(r) for r in substring.substring_dedup(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[3] for r in got)
    assert substring.substring_dedup(nothing).count() == 0


def test_simhash(docs, nothing):
    prints = []
    for i, t in PAIRS:
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    label = {f: f for _, f in prints}
    for _ in prints:
        label = {f: min(label[g] for g in label if (f ^ g).bit_count() <= 2) for f in label}
    first = defaultdict(list)
    for i, f in prints:
        first[label[f]] += [] if i is None else [i]
    want = [(i, f, min(first[label[f]], default=None)) for i, f in prints]
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.simhash_components(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(label.values()))
    assert simhash.simhash_components(nothing).count() == 0


def test_near_fingerprints_share_an_anchor():
    rng = np.random.default_rng(0)
    for x in rng.integers(0, 2**64, 200, dtype=np.uint64):
        y = x
        for b in rng.choice(64, 2, replace=False):
            y ^= np.uint64(1 << int(b))
        a, b = (set(simhash.anchors_of(np.array([v]), 2)[1].tolist()) for v in (x, y))
        assert a & b and len(a) <= 33


def test_packing(docs, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = packing.pack(docs, path).collect()
    want = Counter(
        np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in PAIRS
    )
    parts, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[(r.doc_id, r.doc_tokens)].append(r)
        windows[r.sequence_id].append((r.offset, r.length, r.window))
    for w in windows.values():
        at = 0
        for offset, length, size in sorted(w):
            assert offset == at
            at += length
        assert at == size and size <= 4096 and size & (size - 1) == 0
    joined = Counter()
    for pieces in parts.values():
        copies = sum(p.start == 0 for p in pieces)
        pieces = sorted(pieces, key=lambda p: p.start)
        if copies == 1:
            joined[b"".join(bytes(p.ids) for p in pieces)] += 1
    assert all(joined[k] <= want[k] for k in joined) and sum(joined.values()) >= len(PAIRS) - 2
    assert packing.pack(nothing, path).count() == 0


def test_frequent_words_stay_in_the_cache(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, whole, learned = WordEncoder(path, limit=6), Tokenizer.from_file(path), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learned.extend(new), learn(new)))
    for i in range(12):
        texts = [f"often Often, once{i} été{i}", "", f"often seldom{i % 3} \u00c9t\u00e9 once more{i}"]
        ids, counts = encoder.encode(texts)
        want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
    assert Counter(learned)[b"often"] == 1 and len(encoder.words) < 20


def test_quality(docs, nothing, spark):
    rng = np.random.default_rng(1)
    good = ["The quiet river went past the town.\nNobody saw it leave." for _ in range(40)]
    bad = ["XX!! YY!! ZZ!! QQ!!\nBUY### NOW$$$ %%%" for _ in range(40)]
    texts, y = good + bad, np.array([1] * 40 + [0] * 40)
    order = rng.permutation(80)
    model = quality.fit([texts[i] for i in order], y[order])
    score = model.score(["A calm day came and went.", "ZZ!! AA!! BB###", ""])
    assert score[0] > 0.5 > score[1] and 0 <= score[2] <= 1
    got = quality.score_documents(docs, model).collect()
    assert len(got) == len(PAIRS) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_documents(nothing, model).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert (quality.train(docs, empty).weights == 0).all()


def test_language_model(docs, nothing):
    counts = lm.count_words(docs)
    model = lm.train(docs, counts, known_words=5)
    got = lm.score_documents(docs, counts, model).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter(w for i, t in PAIRS if not held(i) for w in lm.tokens_of(t or ""))
    below = sum(c.values()) + len(c) + 1
    want = []
    for i, t in PAIRS:
        tokens = lm.tokens_of(t or "")
        base = sum(np.log10((c[w] + 1) / below) for w in tokens)
        want.append((str(i), held(i), len(tokens), sum(c[w] > 0 for w in tokens), round(base, 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 and r.train_tokens == sum(c.values()) for r in got)
    none = lm.count_words(nothing)
    assert lm.score_documents(nothing, none, lm.train(nothing, none)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 1 + i % 3, 6)]) for i in range(150)]
    rows += [(200 + i, [0.5] * 6) for i in range(40)] + [(300, None), (310, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(320, [float("nan")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = {
        i: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int)
        for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all()
    }
    want = set()
    for q in [i for i in whole if i % 10 == 0]:
        best = sorted((-int(whole[q] @ whole[o]), o) for o in whole if o != q)[:10]
        want |= {(q, n + 1, o, -s) for n, (s, o) in enumerate(best)}
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0).collect()} == want
    assert topk.top_k(df.filter("false"), F.lit(True)).count() == 0


def _answers(whole, asks, k=10):
    want = set()
    for q in [i for i in whole if asks(i)]:
        best = sorted((-int(whole[q] @ whole[o]), o) for o in whole if o != q)[:k]
        want |= {(q, n + 1, o, -s) for n, (s, o) in enumerate(best)}
    return want


def test_top_k_meets_only_what_can_answer(spark, monkeypatch):
    for name, n in (("BUCKET_ROWS", 64), ("BLOCK_ROWS", 8), ("SEEDS", 64)):
        monkeypatch.setattr(topk, name, n)
    seen, run = [], topk.meetings
    monkeypatch.setattr(topk, "meetings", lambda q, c: seen.append((q, c, *run(q, c))) or seen[-1][2:])
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 2.0 ** -(i % 12), 5)]) for i in range(1200)] + [(5000, [0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in rows}
    got = topk.top_k(df, F.col("vec_id") % 25 == 0)
    assert {tuple(r) for r in got.collect()} == _answers(whole, lambda i: i % 25 == 0)
    asked, held, left, right = seen[0]
    blocks, buckets = asked.select("block").distinct().count(), held.select("bucket").distinct().count()
    pairs = {tuple(r) for r in left.select("block", "bucket").distinct().collect()}
    assert pairs == {tuple(r) for r in right.select("block", "bucket").distinct().collect()}
    assert blocks > 4 and buckets > 10 and len(pairs) < blocks * buckets / 2


def test_top_k_of_several_widths_and_huge_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 2 + i % 4)]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: np.pad(np.floor(1024 * np.array(v)).astype(int), (0, 5 - len(v))) for i, v in rows}
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 9 == 0).collect()} == _answers(whole, lambda i: i % 9 == 0)
    huge = spark.createDataFrame([(1, [1e9, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        topk.top_k(huge, F.lit(True))


def test_html_blocks():
    page = '<p>a&amp;b <b>c</b><br>d<p>e<script>"</p>"</script><!-- x --><li><a href="#">f'
    assert [b.text for b in html.blocks_of(page)] == ["a&b c d", "e", "f"]
    assert html.blocks_of("") == []


def test_html_labels_leave_out_what_is_aside():
    page = """<nav>menu</nav><article class="post"><h1>Title</h1><p>One <i>two</i></p><form><p>Search</p></form>
    <div class="ad box"><p>Buy</p></div><p>Three</p><section id="comments"><p>Nice!</p></section></article><footer>End</footer>"""
    found = html.blocks_of(page)
    assert [b.text for b in found if b.main] == ["Title", "One two", "Three"]
    assert [b.text for b in found if not b.main] == ["menu", "Search", "Buy", "Nice!", "End"]
    assert [b.leaf for b in found if b.main] == ["h1", "p", "p"]


@pytest.mark.parametrize(
    "page", ["<a " * 350_000, "<div>x" * 150_000, '<a "' * 250_000, "<!x " * 250_000, "<p '\"" * 150_000, "</p><div>" * 100_000, "<!-- " * 200_000],
)
def test_broken_markup_takes_one_pass(page):
    from time import process_time

    begin = process_time()
    found = html.blocks_of(page)
    html.features(found[:1000])
    assert process_time() - begin < 5 and len(found) <= 150_000


def test_html_features_read_whole_blocks():
    a, b = (html.features(html.blocks_of("<p>" + "one two three " * 20 + w * 40))[0] for w in ("red ", "blue "))
    assert not np.allclose(a[html.PATH : html.PATH + html.WORDS], b[html.PATH : html.PATH + html.WORDS])


def test_html_extraction(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    network = html.train(pages, 60)
    got = {r.page_id: r.text for r in html.extract(pages, network).collect()}
    want = {}
    for r in pages.collect():
        blocks = html.blocks_of(r.html)
        want[r.page_id] = "\n".join(b.text for b in blocks if b.main)
    assert sum(got[i] == want[i] for i in want) >= 0.98 * len(want)
    odd = spark.createDataFrame([(None, None, None), (1, "u", "")], "page_id long, url string, html string")
    assert [(r.text, r.n_chars) for r in html.extract(odd, network).collect()] == [("", 0), ("", 0)]
    assert html.extract(odd.filter("false"), network).count() == 0


def test_lattice(docs, nothing, make_docs):
    """The ids are the library's own; a mark in a text comes back as a space."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)

    def check(df, pairs):
        want = [(i, (t or "").replace("▁", " "), np.array(library.encode(t or ""), "<u2").tobytes()) for i, t in pairs]
        got = lattice.decode(lattice.encode(df, path, known_words=3), path).collect()
        assert sorted(((r.doc_id, r.text, bytes(r.ids)) for r in got), key=str) == sorted(want, key=str)

    check(docs, PAIRS)
    odd = ["½² १२ ▁a 日本語 😀 (((( 1234 a1b2", "\t\ta \n\n b  ", "-" * 300 + " " * 40 + "z", "a\x00b", "y" * 61]
    odd += [" " * n + "y" for n in range(0, 40, 3)] + [" " * n for n in range(1, 40, 3)]
    pairs = [(None, "same text"), (None, "same text"), *enumerate(odd)]
    check(make_docs(pairs, "word", "mark", "late", "blob"), pairs)
    assert lattice.encode(nothing, path).count() == 0


def test_lattice_reads_texts_once_more_than_it_counts(spark, make_docs):
    """Codes and rare stretches come from one pass, shuffled once for both readers; what was counted is not kept."""
    from hailscope.sources.staging import run_folder

    path = public_tokenizers.path("piece_bpe_32k.model")
    folder = Path(run_folder(spark).removeprefix("file:"))
    before = set(folder.glob("pieces-*"))
    encoded = lattice.encode(make_docs([(i, f"river town, x{i}y z{i}") for i in range(50)]), path, known_words=3)
    assert [f.name[:10] for f in set(folder.glob("pieces-*")) - before] == ["pieces-ids"]
    assert len(encoded.collect()) == 50
    assert "ReusedExchange" in encoded._jdf.queryExecution().executedPlan().toString()


def test_codes_and_holes_of_words():
    ids = [np.array(x, "<u2").tobytes() for x in ([5], [6, 7], [8])]
    known = lattice.Known(pa.table({"word": ["▁river", "▁town", ","], "ids": pa.array(ids, pa.binary())}))
    codes, late = lattice._coder(*known.codes())(["river", "town,", "odd,", "river"])
    assert late == ["▁odd"]
    places = lattice._places(lattice._planes(codes))
    assert places.tolist() == [1, 2, 3, 0, 3, 1]
    filled = lattice._filled(places, *known.spans(), [np.array([9, 9], "<u2").tobytes()])
    assert np.frombuffer(filled, "<u2").tolist() == [5, 6, 7, 8, 9, 9, 8, 5]
    with pytest.raises(ValueError, match="1 holes"):
        lattice._filled(places, *known.spans(), [])


def test_queries_have_what_sql_can_say():
    from hailscope.llm.oracles import ORACLES
    from hailscope.llm.queries import QUERIES

    assert set(ORACLES) < set(QUERIES) and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pipeline_keeps_clean_documents(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert [f.name for f in out.schema] == [f.name for f in docs.schema], name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = corpus_pipeline.stage(out, f"test-{name}")
        assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()
