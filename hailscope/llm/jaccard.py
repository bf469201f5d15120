"""Near duplicates by Jaccard similarity of word n-grams, exact, by way of relations between sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailscope.llm.common import attach, id_text, stage
from hailscope.llm.graph import components
from hailscope.llm.tokens import small_groups
from hailscope.llm.words import Words
from hailscope.operators.sizing import broadcast_within

SHINGLE, PERCENT = 5, 80
#: Share of all grams by whose fellow holders a set shows whether it can have a partner.
SAMPLE = 0.3
#: Leaders that a set may have: one per minimum hash.
LEADERS = 3
#: Times that each list links its groups by one pair each, before all pairs between groups are met.
HUB_TURNS = 1
#: Bits that mark the grams of a set in its index entries.
MARK_BITS = 1024
#: Grams that a task looks at together, and entries of an index list that one task pairs.
CHUNK_GRAMS, LIST_ROWS = 2_000_000, 20_000
#: Candidate pairs held at once.
PAIRS = 200_000
#: A table of ids is broadcast up to this size, measured; beyond it the join shuffles.
ID_BYTES = 32 << 20


def grams_of(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted different 64-bit hashes of the ``size``-word grams of each text; A-Z lower-cased.

    Of a text with fewer words, one hash of them all; none for a text without words.
    """
    words = Words([t.encode().lower().decode() for t in texts])
    runs = {size: words.runs(size)}
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        n = int(min(size, b - a))
        if n and n not in runs:
            runs[n] = words.runs(n)
        out.append(np.unique(runs[n][a : b - n + 1]) if n else np.zeros(0, np.uint64))
    return out


def _class_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _in_sample(grams: np.ndarray) -> np.ndarray:
    return grams < np.uint64(int(SAMPLE * 2**64))


def prints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, cls, n, m``: hash of the text, hash of its set, grams of the set, and those in the sample."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sets = [(_class_of(g), len(g), int(_in_sample(g).sum())) for i, j in small_groups(texts) for g in grams_of(texts[i:j], size)]
            columns = list(zip(*sets, strict=True)) or [()] * 3
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], ["doc_id", "mark", "cls", "n", "m"])

    marked = id_text(docs).withColumn("mark", F.xxhash64("text"))
    return marked.mapInArrow(run, "doc_id long, mark long, cls long, n long, m long")


def _sampled(size: int):
    """Rows ``key, cls, seen`` of a task's different sets.

    ``seen`` NULL: the gram ``key`` is in the set. ``seen`` 0: likewise, but it was
    met in two sets here and is accounted for; only two such rows are sent, however
    many sets hold it. ``seen`` above 0: how many of the set's grams (filed under the set)
    are accounted for.
    """

    def flush(grams, owners):
        if not grams:
            return
        flat, own = np.concatenate(grams), np.repeat(np.array(owners, np.int64), [len(g) for g in grams])
        order = np.argsort(flat, kind="stable")
        flat, own = flat[order], own[order]
        begins = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        sizes = np.diff(np.append(begins, len(flat)))
        alone, many = begins[sizes == 1], np.concatenate([begins[sizes > 1], begins[sizes > 1] + 1])
        classes, times = np.unique(own[np.repeat(sizes > 1, sizes)], return_counts=True)
        seen = pa.array([None] * len(alone), pa.int32())
        yield pa.RecordBatch.from_arrays([_signed(flat[alone]), pa.array(own[alone]), seen], ["key", "cls", "seen"])
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([_signed(flat[many]), pa.array(classes)]),
                pa.array(np.concatenate([own[many], classes])),
                pa.array(np.concatenate([np.zeros(len(many), np.int32), times.astype(np.int32)])),
            ],
            ["key", "cls", "seen"],
        )

    def run(batches):
        known: set[int] = set()
        grams, owners, held = [], [], 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in small_groups(texts):
                for g in grams_of(texts[i:j], size):
                    cls = _class_of(g)
                    if not len(g) or cls in known:
                        continue
                    known.add(cls)
                    grams.append(g[_in_sample(g)])
                    owners.append(cls)
                    held += len(grams[-1])
                if held >= CHUNK_GRAMS:
                    yield from flush(grams, owners)
                    grams, owners, held = [], [], 0
        yield from flush(grams, owners)

    return run


def _shared(batches):
    """``cls, shared``: how many grams of a set have another holder, from rows sorted by (key, cls, seen)."""
    last, told = None, False  # the gram's row before this batch, and whether it has been counted
    for batch in batches:
        key, cls = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        null = batch.column(2).is_null().to_numpy(zero_copy_only=False)
        seen = batch.column(2).fill_null(0).to_numpy()
        total = seen > 0
        out_cls, out_n = [cls[total]], [seen[total].astype(np.int64)]
        key, cls, count = key[~total], cls[~total], null[~total]
        if last is not None:
            key, cls, count = np.append(last[0], key), np.append(last[1], cls), np.append(last[2] and not told, count)
        if len(key):
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])])
            key, cls, count = key[new], cls[new], count[new]
            same = np.concatenate([[False], key[1:] == key[:-1], [False]])
            shared = same[1:] | same[:-1]
            classes, times = np.unique(cls[shared & count], return_counts=True)
            out_cls.append(classes)
            out_n.append(times)
            carried = last is not None and len(key) == 1
            last, told = (key[-1], cls[-1], count[-1]), bool(shared[-1]) or (carried and told)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_cls)), pa.array(np.concatenate(out_n))], ["cls", "shared"])


def _needed(n: Column, percent: int) -> Column:
    """Grams that a set of ``n`` must have in common with any partner."""
    return F.ceil(n * percent / 100)


def candidates_alone(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of ``classes`` (``cls, n, m``) that may have a partner.

    A set can miss ``n - needed`` grams in a partner at most, wherever they are; so
    of its grams in the sample no more than that may be without another holder.
    """
    rows = id_text(docs).mapInArrow(_sampled(size), "key long, cls long, seen int")
    rows = rows.repartition("key").sortWithinPartitions("key", "cls", F.col("seen").asc_nulls_last())
    shared = rows.mapInArrow(_shared, "cls long, shared long").groupBy("cls").agg(F.sum("shared").alias("shared"))
    lonely = F.col("m") - F.coalesce("shared", F.lit(0))
    met = classes.filter("n > 0").join(shared, "cls", "left")
    return met.filter(lonely <= F.col("n") - _needed(F.col("n"), percent)).drop("shared")


def _all_grams(size: int):
    def run(batches):
        known: set[int] = set()  # rows may repeat
        for batch in batches:
            texts, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in small_groups(texts):
                new = {cls: text for cls, text in zip(wanted[i:j], texts[i:j], strict=True) if cls not in known}
                known.update(new)
                if new:
                    grams = grams_of(list(new.values()), size)
                    owner = np.repeat(np.array(list(new), np.int64), [len(g) for g in grams])
                    yield pa.RecordBatch.from_arrays([_signed(np.concatenate(grams)), pa.array(owner)], ["gram", "cls"])

    return run


def residual_sets(docs: DataFrame, alive: DataFrame, size: int, percent: int) -> DataFrame:
    """``cls, n, grams, k0..`` of the sets that may have a partner *(action)*.

    ``grams`` are those that another such set holds, the rarest first (ties by hash),
    an order that is the same in all sets; ``n`` counts the whole set. ``k0..`` are
    minimum hashes of the grams.
    """
    reps = alive.select(F.col("rep.id").alias("rep_id"), F.col("rep.mark").alias("mark"), F.col("cls"))
    reps = broadcast_within(reps, ID_BYTES)
    texts = id_text(docs).withColumn("mark", F.xxhash64("text"))
    texts = texts.join(reps, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (texts["mark"] == reps["mark"]))
    rows = stage(texts.select("text", "cls").mapInArrow(_all_grams(size), "gram long, cls long"), "jaccard-grams")
    often = rows.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    often = stage(often, "jaccard-often")
    found = attach(rows, often, ["gram"], "df", rows.count())
    ordered = F.array_sort(F.collect_set(F.struct("df", "gram")))["gram"].alias("grams")
    hashes = [
        F.array_min(F.transform("grams", lambda g, i=i: F.xxhash64(g, F.lit(i)))).alias(f"k{i}") for i in range(LEADERS)
    ]
    sets = found.groupBy("cls").agg(ordered).join(alive.select("cls", "n"), "cls")
    lonely = F.col("n") - F.size("grams")
    sets = sets.filter(lonely <= F.col("n") - _needed(F.col("n"), percent))
    return stage(sets.select("cls", "n", "grams", *hashes), "jaccard-sets")


def _similar(common: Column, n1: Column, n2: Column, percent: int) -> Column:
    return (100 + percent) * common >= percent * (n1 + n2)


def leaders(sets: DataFrame, percent: int) -> DataFrame:
    """``cls, leader, plus, minus``: sets linked to a leader, and what they hold more and less *(action)*.

    Of the sets with the same minimum hash one leads; with several hashes, several may.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("key")) for i in range(LEADERS)])
    members = sets.select("cls", F.inline(keys))
    first = F.min(F.struct(F.xxhash64("cls", "i").alias("h"), "cls"))["cls"].alias("leader")
    heads = members.groupBy("i", "key").agg(first, F.count("*").alias("members")).filter("members > 1")
    heads = stage(heads, "jaccard-heads")
    several = attach(members, heads, ["i", "key"], "members", LEADERS * sets.count())
    several = stage(several.select("cls", "leader").filter("cls <> leader").distinct(), "jaccard-led")
    heads = sets.select(F.col("cls").alias("leader"), F.col("grams").alias("lead"), F.col("n").alias("n_lead"))
    led = several.join(sets.select("cls", "n", "grams"), "cls")
    met = led.join(heads.hint("merge"), "leader")  # rows as long as texts are not broadcast
    plus, minus = F.array_except("grams", "lead").alias("plus"), F.array_except("lead", "grams").alias("minus")
    met = met.select("cls", "leader", "n", "n_lead", F.size("grams").alias("own"), plus, minus)
    common = F.col("own") - F.size("plus")
    linked = met.filter(_similar(common, F.col("n"), F.col("n_lead"), percent))
    return stage(linked.select("cls", "leader", "plus", "minus"), "jaccard-leaders")


def index_entries(sets: DataFrame, percent: int) -> DataFrame:
    """``gram, cls, n, at, lonely, bits``: the prefix of each set, ``at`` being the place in it *(action)*.

    The ``lonely`` grams without another holder stand in front of all others, so they use
    up places and are in no list. ``bits`` marks all other grams of the set in
    ``MARK_BITS`` bits, for :func:`pair_list`.
    """

    def run(batches):
        for batch in batches:
            cls, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            flat, ends = batch.column(2).flatten().to_numpy(), batch.column(2).value_lengths().to_numpy().cumsum()
            sizes = np.diff(ends, prepend=0)
            marks = np.zeros((len(cls), MARK_BITS), bool)
            marks[np.repeat(np.arange(len(cls)), sizes), (flat >> 20) & (MARK_BITS - 1)] = True
            bits = np.packbits(marks, axis=1)
            lonely = n - sizes
            taken = n - np.ceil(n * percent / 100).astype(np.int64) + 1 - lonely
            owner = np.repeat(np.arange(len(cls)), taken)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(taken) - taken, taken)
            columns = [flat[(ends - sizes)[owner] + within], cls[owner], n[owner], lonely[owner] + within, lonely[owner]]
            stored = pa.array([b.tobytes() for b in bits], pa.binary()).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), stored], ["gram", "cls", "n", "at", "lonely", "bits"])

    rows = sets.select("cls", F.col("n").cast("long").alias("n"), "grams")
    rows = rows.mapInArrow(run, "gram long, cls long, n long, at long, lonely long, bits binary")
    return stage(rows, "jaccard-entries")


def _grouped(entries: DataFrame, groups: DataFrame) -> DataFrame:
    return entries.join(groups, "cls", "left").withColumn("grp", F.coalesce("grp", "cls"))


def hub_pairs(entries: DataFrame, groups: DataFrame, turn: int, percent: int) -> DataFrame:
    """``a, b``: in every index list, one set of each group, and the one set that all are held against.

    A list gives one pair per group in it, however many sets the groups have. Both are
    picked by a hash that differs from turn to turn.
    """
    pick = F.struct(F.xxhash64("cls", F.lit(turn)).alias("h"), "cls", "n", "grp")
    seats = _grouped(entries, groups).groupBy("gram", "grp").agg(F.min(pick).alias("rep"))
    hubs = seats.groupBy("gram").agg(F.min("rep").alias("hub"))
    met = seats.join(hubs, "gram").filter(F.col("hub.grp") != F.col("grp"))
    sizes = F.least("rep.n", "hub.n"), F.greatest("rep.n", "hub.n")
    met = met.filter(100 * sizes[0] >= percent * sizes[1])
    ends = F.col("rep.cls"), F.col("hub.cls")
    return met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()


def mixed_lists(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """The entries, with ``grp`` and the list's ``rows``, of lists whose sets are not all of one group.

    Links within a group are known, so the other lists have nothing to add.
    """
    entries = stage(_grouped(entries, groups), "jaccard-grouped")
    mixed = entries.groupBy("gram").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi"), F.count("*").alias("rows"))
    mixed = stage(mixed.filter("lo <> hi").select("gram", "rows"), "jaccard-lists")
    return attach(entries, mixed, ["gram"], "rows", entries.count())


def pair_list(entry: dict[str, np.ndarray], shares: tuple[int, int], percent: int):
    """Pairs of entries of one list that can be similar, of different groups: chunks of two index arrays.

    The list is held as blocks of equal place, each sorted by size. For an entry and a
    block, size and place bound the sizes of possible partners from both sides, so
    it meets one run of the block, and blocks without any are skipped. Of the pairs met,
    those go whose marked bits and lonely grams alone differ too often. ``shares``: only
    pairs of an entry of one share of the list and one of the other.
    """
    n, at, grp, share, lonely, bits = (entry[c] for c in ("n", "at", "grp", "share", "lonely", "bits"))
    order = np.lexsort((n, at))
    begins = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) != 0]))
    most = np.minimum((100 * n - (100 + percent) * at) // percent, 100 * n // percent)
    for begin, end in zip(begins, np.append(begins[1:], len(order)), strict=True):
        block = order[begin:end]
        place = int(at[block[0]])
        least = -((-(percent * n + (100 + percent) * place)) // 100)
        lo, hi = np.searchsorted(n[block], least, "left"), np.searchsorted(n[block], most, "right")
        runs = np.maximum(hi - lo, 0)
        askers = np.flatnonzero(runs)
        if not len(askers):
            continue
        ends = np.cumsum(runs[askers])
        cuts = np.append(np.searchsorted(ends, np.arange(0, ends[-1], PAIRS)), len(askers))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some = askers[a:b]
            if not len(some):
                continue
            left = np.repeat(some, runs[some])
            first = np.repeat(lo[some] - (np.cumsum(runs[some]) - runs[some]), runs[some])
            right = block[first + np.arange(len(left))]
            keep = grp[left] != grp[right]
            if shares[0] == shares[1]:
                keep &= (at[left] < at[right]) | ((at[left] == at[right]) & (left < right))
            else:
                keep &= (share[left] == shares[0]) & (share[right] == shares[1])
            left, right = left[keep], right[keep]
            differ = lonely[left] + lonely[right] + np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1, dtype=np.int64)
            keep = (100 + percent) * differ <= (100 - percent) * (n[left] + n[right])
            yield left[keep], right[keep]


LIST = ["gram", "s1", "s2"]
ENTRY = ["cls", "n", "at", "grp", "share", "lonely", "bits"]


def _pairs(percent: int):
    """Candidate pairs of every list; lists may go on in the next batch."""

    def of_lists(table):
        lists = [table.column(c).to_numpy() for c in LIST]
        entry = {c: table.column(c).to_numpy() for c in ENTRY[:-1]}
        marks = b"".join(table.column("bits").to_pylist())
        entry["bits"] = np.frombuffer(marks, np.uint64).reshape(len(lists[0]), MARK_BITS // 64)
        edges = sum(np.diff(c) != 0 for c in lists) > 0
        cuts = np.concatenate([[0], np.flatnonzero(edges) + 1, [len(lists[0])]])
        found, held = [], 0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            own = {c: v[a:b] for c, v in entry.items()}
            for left, right in pair_list(own, (lists[1][a], lists[2][a]), percent):
                if len(left):
                    found.append(np.sort(np.stack([own["cls"][left], own["cls"][right]], axis=1), axis=1))
                    held += len(left)
                if held >= PAIRS:
                    yield np.unique(np.concatenate(found), axis=0)
                    found, held = [], 0
        if found:
            yield np.unique(np.concatenate(found), axis=0)

    def batch_of(ends):
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            key = [table.column(c).to_numpy() for c in LIST]
            other = np.flatnonzero(sum(c != c[-1] for c in key) > 0)
            cut = int(other[-1]) + 1 if len(other) else 0
            for ends in of_lists(table.slice(0, cut)) if cut else ():
                yield batch_of(ends)
            rest = table.slice(cut)
        for ends in of_lists(rest) if rest is not None else ():
            yield batch_of(ends)

    return run


def candidate_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """``a, b``: every two sets of different groups that one index list allows to be similar.

    A list over ``LIST_ROWS`` is cut in shares, and every two shares meet in a group of
    their own, so no task holds more than two shares and no pair is lost.
    """
    n = F.ceil(F.col("rows") / LIST_ROWS).cast("int")
    own = F.pmod(F.xxhash64("cls"), n).cast("int")
    dealt = entries.withColumns({"shares": n, "share": own})
    meets = F.transform(
        F.sequence(F.lit(0), F.col("shares") - 1),
        lambda s: F.struct(F.least(s, F.col("share")).alias("s1"), F.greatest(s, F.col("share")).alias("s2")),
    )
    dealt = dealt.withColumn("meet", F.explode(meets)).select("gram", "meet.*", *ENTRY)
    sorted_lists = dealt.repartition(*LIST).sortWithinPartitions(*LIST)
    return sorted_lists.mapInArrow(_pairs(percent), "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, led: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are similar *(action)*.

    The answer of a set with a leader is derived from the leader's: the common grams
    of leader and ``b`` are counted once, and corrected by what ``a`` holds more and
    less. The corrections' sizes alone settle many pairs; only the others read the
    grams of ``b`` again.
    """
    change = F.size("plus") + F.size("minus")
    one = led.groupBy("cls").agg(F.min_by(F.struct("leader", "plus", "minus"), F.struct(change, "leader")).alias("by"))
    nothing = F.array().cast("array<bigint>")
    asked = pairs.join(one, F.col("a") == F.col("cls"), "left").select(
        "a",
        "b",
        F.coalesce("by.leader", "a").alias("leader"),
        F.coalesce("by.plus", nothing).alias("plus"),
        F.coalesce("by.minus", nothing).alias("minus"),
    )
    asked = stage(asked, "jaccard-asked")
    grams = sets.select("cls", "grams")
    base = asked.select("leader", "b").distinct()
    base = base.join(grams.withColumnsRenamed({"cls": "leader", "grams": "lead"}), "leader")
    base = base.join(grams.withColumnsRenamed({"cls": "b", "grams": "other"}), "b")
    base = base.select("leader", "b", F.size(F.array_intersect("lead", "other")).alias("base"))
    sizes = sets.select("cls", "n")
    known = asked.join(base, ["leader", "b"])
    known = known.join(sizes.withColumnsRenamed({"cls": "a", "n": "na"}), "a")
    known = stage(known.join(sizes.withColumnsRenamed({"cls": "b", "n": "nb"}), "b"), "jaccard-known")

    def similar(common: Column) -> Column:
        return _similar(common, F.col("na"), F.col("nb"), percent)

    at_least, at_most = similar(F.col("base") - F.size("minus")), similar(F.col("base") + F.size("plus"))
    sure = known.filter(at_least).select("a", "b")
    open_ = known.filter(~at_least & at_most).join(grams.withColumnsRenamed({"cls": "b", "grams": "other"}), "b")
    common = (
        F.col("base") + F.size(F.array_intersect("plus", "other")) - F.size(F.array_intersect("minus", "other"))
    )
    return sure.unionByName(open_.filter(similar(common)).select("a", "b"))


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``cls, grp`` after links between sets of different groups *(action)*."""
    for end in ("a", "b"):
        named = groups.withColumnsRenamed({"cls": end, "grp": "of"})
        links = links.join(named, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    merged = stage(components(links), "jaccard-merged")
    known = groups.join(merged.withColumnRenamed("node", "grp"), "grp", "left")
    known = known.select("cls", F.coalesce("root", "grp").alias("grp"))
    fresh = merged.withColumnsRenamed({"node": "cls", "root": "grp"}).join(groups, "cls", "left_anti")
    return stage(known.unionByName(fresh), "jaccard-groups")


def similar_sets(docs: DataFrame, alive: DataFrame, size: int, percent: int) -> DataFrame:
    """``cls, grp`` of every set that is linked to another *(action)*.

    Groups are grown by leaders, then a few times by one pair per list and group,
    which leaves few groups to a family of near copies. Then all remaining pairs between
    groups are met, so the turns before decide the work, not the result.
    """
    sets = residual_sets(docs, alive, size, percent)
    led = leaders(sets, percent)
    groups = components(led.select(F.col("cls").alias("a"), F.col("leader").alias("b")))
    groups = stage(groups.select(F.col("node").alias("cls"), F.col("root").alias("grp")), "jaccard-groups")
    entries = index_entries(sets, percent)
    for turn in range(HUB_TURNS):
        pairs = stage(hub_pairs(entries, groups, turn, percent), "jaccard-hubs")
        groups = _joined(groups, verified(pairs, sets, led, percent))
    pairs = stage(candidate_pairs(mixed_lists(entries, groups), percent), "jaccard-pairs")
    return _joined(groups, verified(pairs, sets, led, percent))


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document *(action)*.

    A document's set are its different ``size``-word grams (A-Z lower-cased), or all
    its words as one gram if they are fewer. Two sets link if their intersection is at least
    ``percent`` % of their union; ``component_id`` is the smallest id reachable.

    Equal sets are one from the start. A set can have a partner only if nearly all its
    grams have other holders; a sample of all grams, the same for every set, rules most
    sets out, exactly. The others are related first: of those that share a minimum hash one
    leads, and members close to it are linked to it. Then comes a prefix index
    over grams, rarest first. Each list first holds one set of every group against one
    hub, which joins groups. Lists within one group are then skipped; in the others,
    blocks of equal place are skipped by size, and pairs by marked bits. A candidate's
    overlap is derived from its leader's. Only links between different groups matter to a component, so groups of
    near copies do not expand into pairs.

    Grams and sets are known by 64-bit hashes. A gram of many sets costs two rows per
    task, lists over ``LIST_ROWS`` are dealt out by pairs of shares, and joins with hot
    keys go by :func:`attach`. NULL and empty texts and those without words are linked
    with nothing. Rows that repeat are one class. A NULL id is never the smallest; a
    class of NULL ids alone has NULL. Texts of any length are taken whole. An empty
    table gives no rows. Other columns are not read.
    """
    own = stage(prints(docs, size), "jaccard-prints")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "mark")).alias("rep")
    classes = own.groupBy("cls").agg(rep, F.first("n").alias("n"), F.first("m").alias("m"), F.count("*").alias("copies"))
    classes = stage(classes, "jaccard-classes")
    alive = stage(candidates_alone(docs, classes, size, percent), "jaccard-alive")
    groups = similar_sets(docs, alive, size, percent)
    rooted = classes.join(groups, "cls", "left").select("cls", "rep", "copies", F.coalesce("grp", "cls").alias("root"))
    low = rooted.groupBy("root").agg(F.min("rep.id").alias("component"), F.count("*").alias("members"))
    low = stage(low, "jaccard-low")
    named = stage(attach(rooted, low, ["root"], "members", classes.count()).select("cls", "copies", "component"), "jaccard-named")
    out = attach(own, named, ["cls"], "copies", own.count())
    empty = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(empty, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
