"""Spelling variants, the Jaccard join and the manifest against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hailscope.llm import jaccard, manifest, queries, substring, variants
from hailscope.llm.words import Words

CLASHES = ("word", "n", "key", "cls", "grp", "mark", "gram", "tree", "leaf", "size", "place", "node", "root", "path", "doc", "n_near")


def lower(text):
    return text.encode().lower().decode()


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def nothing(make_docs):
    return make_docs([]).filter("false")


# -- spelling variants -----------------------------------------------------------------


def brute_variants(pairs):
    seen = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                seen[run] += 1
    words = {w: n for w, n in seen.items() if n >= 2}
    letters = sorted({c for w in words for c in w})

    def near(w):
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        out = {a + b[1:] for a, b in cuts if b}
        out |= {a + c + b[1:] for a, b in cuts if b for c in letters}
        out |= {a + c + b for a, b in cuts for c in letters}
        return (out & words.keys()) - {w}

    found = {w: near(w) for w in words}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(found[w]), words.get(form[w], 0)) for w, n in words.items())


def spelled(rng):
    """Texts over a few letters, so that near words abound, and chains of ever more frequent forms."""
    base = ["".join(rng.choice("aaab") for _ in range(rng.randint(7, 9))) for _ in range(150)]
    texts = [" ".join(rng.choice(base) for _ in range(60)) for _ in range(40)]
    chain = ["chainedword", "chainedwors", "chainedworsu", "chainedworsuu"]
    texts += [" ".join([chain[0]] * 900 + [chain[1]] * 60 + [chain[2]] * 4 + [chain[3]] * 2)]
    texts += ["aaaaaaa " * 30, "aaaaaaaa " * 3 + "aaaaaaaaa× " * 2, "ÀÉÎÕÜ÷ÿ ÀÉÎÕÜ÷ÿ àéîõüÿÿ", "Straße123straße Straßenbahn STRASSENBAHN straßenbahn"]
    return texts


def test_spelling_variants(make_docs, nothing):
    rng = random.Random(3)
    pairs = list(enumerate(spelled(rng)))
    pairs += [(1, pairs[1][1]), (None, "nobodyknows nobodyknows"), (50, None), (51, ""), (52, " \n\t"), (53, "shorter " * 20000)]
    want = brute_variants(pairs)
    got = variants.spelling_variants(make_docs(pairs, *CLASHES))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in got.collect())
    assert got == want
    assert sum(n for *_, n, _ in want) > 100 and any(r[1] and r[2] not in ("", r[1]) for r in want)
    assert variants.spelling_variants(nothing).count() == 0


def test_pivots_are_two_disjoint_bigrams_of_the_prefix():
    rng = random.Random(1)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(7, 12))) for _ in range(300)} | {"a" * 7, "ab" * 5}
    counts = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    ranks = {g: (i, n) for i, (g, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0])))}
    for w in words:
        positions, last = variants.prefix_of(w, ranks)
        assert len(positions) >= variants.PREFIX and all(ranks[w[p : p + 2]][0] <= last for p in positions)
        first, second = variants.pivots_of(w, positions, ranks)
        assert {first, second} <= set(positions) and second >= first + 2

        def cost(p, q, w=w):
            return ranks[w[p : p + 2]][1] * variants.SHRINK**-p + ranks[w[q : q + 2]][1] * variants.SHRINK ** (q - len(w) + 2)

        assert cost(first, second) == min(cost(p, q) for p in positions for q in positions if q >= p + 2)


# -- Jaccard join ------------------------------------------------------------------------


def brute_jaccard(pairs, size=5, percent=80):
    sets = []
    for _, text in pairs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(pairs):
        low[find(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in low.items()}
    return sorted(((d, len(s), d if not s else least[find(i)]) for i, ((d, _), s) in enumerate(zip(pairs, sets))), key=str)


def near_copies(rng):
    """Families at every distance around the threshold, hot passages, copies, short texts."""
    fresh = iter(range(10**9))
    passage = " ".join(f"p{i}" for i in range(40))
    pairs = []

    def add(words):
        pairs.append((1000 + len(pairs), " ".join(words)))

    for family in range(6):
        base = [f"f{family}w{i}" for i in range(150)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = f"x{next(fresh)}"
            add(words[rng.randint(0, 20) :])
    for _ in range(30):
        add([f"o{next(fresh)}" for _ in range(rng.randint(5, 60))] + passage.split())
    pairs += [(i, t) for i, t in enumerate([None, "", " \n", "one", "ONE", "one two", "a b c d", "A b  c\td", "a b c d e"])]
    pairs += [(7, "a b c d"), (None, "a b c d e f"), (None, "nobody else has these words"), (None, None)]
    pairs += [(500 + i, pairs[0][1].upper()) for i in range(40)] + [pairs[0], pairs[0]]
    exact = [f"e{i}" for i in range(49)]  # 45 grams; 5 of 50 differ, so 40 of 50 is just enough
    add(exact)
    add([*exact[:-5], *(f"y{i}" for i in range(5))])
    add([*exact[:-5], *(f"z{i}" for i in range(6))])
    return pairs


@pytest.mark.parametrize("rows, turns", [(20_000, 1), (15, 0)])
def test_jaccard_components(make_docs, nothing, monkeypatch, rows, turns):
    monkeypatch.setattr(jaccard, "LIST_ROWS", rows)
    monkeypatch.setattr(jaccard, "HUB_TURNS", turns)
    pairs = near_copies(random.Random(9))
    want = brute_jaccard(pairs)
    out = jaccard.jaccard_components(make_docs(pairs, *CLASHES, parts=7))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == want
    assert 10 < len({c for *_, c in want}) < len(want) - 100
    assert jaccard.jaccard_components(nothing).count() == 0


def test_sample_rules_out_no_partner(make_docs):
    """A set of a pair is never ruled out, whatever falls in the sample."""
    pairs = near_copies(random.Random(4))
    docs = make_docs(pairs)
    classes = jaccard.prints(docs).groupBy("cls").agg(F.first("n").alias("n"), F.first("m").alias("m"))
    alive = {r.cls for r in jaccard.candidates_alone(docs, classes, 5, 80).collect()}
    sets = {jaccard._class_of(g): set(g.tolist()) for g in jaccard.grams_of([t or "" for _, t in pairs])}
    for a, x in sets.items():
        for b, y in sets.items():
            if a != b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                assert {a, b} <= alive
    assert len(alive) < len(sets)


def test_lists_lose_no_similar_pair():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(120):
        base = rng.integers(0, 60, 1)[0]
        sets.append(np.unique(np.concatenate([np.arange(base, base + 50), rng.integers(1000, 2000, rng.integers(0, 9))])))
    for share in range(3):
        entry = defaultdict(list)
        for i, s in enumerate(sets):
            if 59 in s:
                marks = np.zeros(jaccard.MARK_BITS, bool)
                marks[(s * 7919) % jaccard.MARK_BITS] = True
                for c, v in (("n", len(s)), ("at", int(np.searchsorted(s, 59))), ("grp", i), ("share", i % 3), ("lonely", 0)):
                    entry[c].append(v)
                entry["bits"].append(np.packbits(marks).view(np.uint64))
                entry["own"].append(i)
        entry = {c: np.array(v) for c, v in entry.items()}
        whole = share == 2
        chosen = np.ones(len(entry["own"]), bool) if whole else np.isin(entry["share"], [share, share + 1])
        entry = {c: v[chosen] for c, v in entry.items()}
        shares = (0, 0) if whole else (share, share + 1)
        own, got = entry["own"], set()
        for left, right in jaccard.pair_list(entry, shares, 80):
            got |= {frozenset((int(own[a]), int(own[b]))) for a, b in zip(left, right)}
        want = set()
        for a in own:
            for b in own:
                same = len(np.intersect1d(sets[a], sets[b]))
                # The list is the first gram in common, as prefixes are filtered by place.
                first = np.intersect1d(sets[a], sets[b])[:1]
                if a < b and 180 * same >= 80 * (len(sets[a]) + len(sets[b])) and first == 59 and (whole or a % 3 != b % 3):
                    want.add(frozenset((int(a), int(b))))
        assert want <= got


# -- manifest ----------------------------------------------------------------------------


def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return digest("".join(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def tree(nodes):
        paths = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(paths):
                run = nodes[at[i] // 8 * 8 :][:8]
                p.append(("".join(run[: at[i] % 8]), "".join(run[at[i] % 8 + 1 :])))
            at = [a // 8 for a in at]
            nodes = [digest("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        return nodes[0], paths

    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    for members in by_lang.values():
        members.sort(key=lambda m: m[:3])
    trees = {v: tree([m[2] for m in by_lang[v]]) for v in langs}
    root, above = tree([trees[v][0] for v in langs])
    out = []
    for v, up in zip(langs, above):
        for (_, _, own, r), path in zip(by_lang[v], trees[v][1]):
            h, text = own, r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                h = leaf(r, lower(text))
            for a, b in path + up:
                h = digest(a + h + b)
            proof = digest("".join(a + b for a, b in path + up))
            out.append((r["doc_id"], own, trees[v][0], root, proof, h, h == root))
    return sorted(out, key=str)


def with_langs(make_docs, rng, sizes):
    pairs, langs = [], []
    for lang, n in sizes.items():
        for _ in range(n):
            i = rng.randint(0, 10**6) if rng.random() < 0.98 else None
            pairs.append((i, rng.choice([None, "", "lower", f"Text {i} ÄÖ\n", "Ä" * 300])))
            langs.append(lang)
    frame = make_docs(pairs, *CLASHES).toPandas()
    frame["lang"] = langs
    return frame.sample(frac=1, random_state=1)


def proofs(spark, frame, schema, parts=5):
    rows = [tuple(None if v is None or v != v else v for v in r) for r in frame.itertuples(index=False)]
    rows = [(None if r[0] is None else int(r[0]), *r[1:4], None if r[4] is None else int(r[4]), *r[5:]) for r in rows]
    docs = spark.createDataFrame(rows, schema).repartition(parts)
    out = manifest.manifest(docs)
    folded = manifest.fold(F.coalesce("forged", "leaf"), F.col("path")).alias("folded_root")
    got = out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("path")), 256).alias("proof"), folded
    ).collect()
    want = brute_manifest([dict(zip(schema.names, r)) for r in rows])
    assert sorted(((*r, r.folded_root == r.root) for r in got), key=str) == want
    return want


@pytest.mark.parametrize(
    "sizes",
    [
        {"en": 1},
        {"en": 8, None: 1},
        {"en": 9, "": 64, "é": 65, "de": 2},
        {"en": 600, None: 513, "fr": 7},
        {f"l{i}": 1 + i % 3 for i in range(70)},
    ],
)
def test_manifest(spark, make_docs, sizes):
    schema = make_docs([], *CLASHES).schema
    frame = with_langs(make_docs, random.Random(len(sizes)), sizes)
    want = proofs(spark, frame, schema)
    if len(want) > 100:
        assert 0 < sum(not ok for *_, ok in want) < len(want) / 2


def test_manifest_over_several_rounds(spark, make_docs, monkeypatch):
    monkeypatch.setattr(manifest, "DIGITS", 1)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    sizes = {"en": 700, "fr": 65, None: 3}
    proofs(spark, with_langs(make_docs, random.Random(5), sizes), make_docs([], *CLASHES).schema)


def test_manifest_of_ties_and_nothing(spark, make_docs, nothing):
    docs = make_docs([(1, "Same")] * 30 + [(1, "Other"), (None, "x"), (None, "x"), (2, "long " * 500_000)])
    rows = [r.asDict() for r in docs.collect()]
    out = manifest.manifest(docs)
    got = out.select("doc_id", "leaf", "subroot", "root", manifest.siblings(F.col("path")).alias("s"), manifest.fold(F.coalesce("forged", "leaf"), F.col("path")).alias("f"))
    got = sorted(((r.doc_id, r.leaf, r.subroot, r.root, digest(r.s), r.f, r.f == r.root) for r in got.collect()), key=str)
    assert got == brute_manifest(rows)
    assert manifest.manifest(nothing).count() == 0


# -- the registered queries ----------------------------------------------------------------


def test_queries_return_the_contract(spark, make_docs, tmp_path):
    pairs = near_copies(random.Random(2))[:80] + list(enumerate(spelled(random.Random(2))))
    make_docs(pairs).write.parquet(str(tmp_path / "documents.parquet"))
    names = {
        "op11_spelling_variants": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
        "op12_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
        "op13_merkle_manifest": {
            "doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
            "folded_root": "string", "verified": "boolean",
        },
    }
    got = {n: queries.QUERIES[n](spark, str(tmp_path)) for n in names}
    for name, columns in names.items():
        assert dict(got[name].dtypes) == columns
    assert sorted(r.word for r in got["op11_spelling_variants"].collect()) == [w for w, *_ in brute_variants(pairs)]
    assert sorted((tuple(r) for r in got["op12_jaccard_join"].collect()), key=str) == brute_jaccard(pairs)
    assert got["op13_merkle_manifest"].count() == len(pairs)


# -- searches of the substring index ---------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_index_searches_find_every_repeated_window(seed):
    from hailscope.llm.fm_index import FMIndex

    rng = np.random.default_rng(seed)
    least, kinds = 4 + seed, (3, 8, 50)[seed % 3]
    base = [rng.integers(1, kinds, rng.integers(1, 60)) for _ in range(12)]
    sequences = []
    for _ in range(40):
        s = base[rng.integers(0, len(base))].copy()
        for _ in range(rng.integers(0, 3)):
            s[rng.integers(0, len(s))] = rng.integers(1, 2 * kinds)
        sequences.append(s)
    symbols = np.concatenate([np.append(s, 0) for s in sequences])
    ends = np.cumsum([len(s) + 1 for s in sequences]) - 1
    begins = ends - [len(s) for s in sequences]
    got = set()
    for lane, at, stop in zip(*FMIndex(symbols).repeats(symbols, begins, ends, least)):
        got |= {(int(lane), int(p) - int(begins[lane])) for p in range(at, stop)}
    windows = Counter(tuple(s[i : i + least]) for s in sequences for i in range(len(s) - least + 1))
    want = {
        (k, p) for k, s in enumerate(sequences) for i in range(len(s) - least + 1)
        if windows[tuple(s[i : i + least])] > 1 for p in range(i, i + least)
    }
    assert got == want and (want or least > 8)


def test_segments_are_cut_without_a_call_per_word():
    """One call per word of every window would be 35 per segment here."""
    text = " ".join(f"w{k}" for k in range(1500))
    hot = Words([text]).runs(16).view(np.int64).tolist()
    names = ["doc_id", "mark", "text", "cold", "hot"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    batch = pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((7, 8, text, [], hot), kinds, strict=True)], names)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        found = list(substring._cut_segments(35, 16)([batch]))
    finally:
        sys.setprofile(None)
    table = pa.Table.from_batches(found)
    assert table["at"].to_pylist() == list(range(1466))
    assert table["words"].to_pylist() == [" ".join(f"w{k}" for k in range(i, i + 35)) for i in range(1466)]
    assert calls < 2 * table.num_rows
