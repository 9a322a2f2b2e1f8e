"""Fingerprints, SimHash, repeated spans and mixing against brute force, on given and awkward rows."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from fieldledger.llm import fuzzy, mixing, repeats, simhash
from fieldledger.llm.queries import corpus_queries
from tests.llm.fixtures import DATA, DOCS, awkward, clashing, given, ordered, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(params=["given", "awkward", "empty"])
def docs(request, spark):
    if request.param == "given":
        return spark.createDataFrame(given("documents"), DOCS)
    return clashing(awkward(spark)) if request.param == "awkward" else spark.createDataFrame([], DOCS)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_fuzzy_fingerprints(docs):
    found = rows(fuzzy.fingerprints(docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
    source = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    assert Counter((r[0], r[1]) for r in found) == Counter((i, len(t)) for i, t in source)
    unique = len({i for i, _ in source}) == len(source)
    if unique and source:
        source.sort()
        expected = {}
        for k, (i, t) in enumerate(source):
            after = source[(k + 1) % len(source)][1]
            expected[i] = (sha(t[: len(t) - len(t) // 4] + after[: len(t) // 4]), fuzzy.fingerprint(t), fuzzy.fingerprint(after))
        for doc_id, _, edited_sha, mark, edited, near_edited, near_next in found:
            assert (edited_sha, mark) == expected[doc_id][:2]
            assert near_edited == pytest.approx(alike(mark, edited)) and near_next == pytest.approx(alike(mark, expected[doc_id][2]))
    assert all(0 <= r[5] <= 1 and 0 <= r[6] <= 1 for r in found)


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def alike(x: str, y: str) -> float:
    if x == y:
        return 1.0
    (bx, x1, x2), (by, y1, y2) = x.split(":"), y.split(":")

    def near(a: str, b: str) -> float:
        if not a or not b:
            return 0.0
        n = min(fuzzy.COMMON, -(-min(len(a), len(b)) // 2))
        if not {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)}:
            return 0.0
        return 1 - edits(a, b) / max(len(a), len(b))

    if bx == by:
        return max(near(x1, y1), near(x2, y2))
    if int(bx) == 2 * int(by):
        return near(x1, y2)
    return near(x2, y1) if int(by) == 2 * int(bx) else 0.0


def test_a_local_edit_changes_few_letters(spark):
    text = " ".join(f"word{i * 7919 % 1013}" for i in range(3000))
    one = fuzzy.fingerprint(text)
    assert alike(one, fuzzy.fingerprint(text[:9000] + "changed" + text[9000:])) > 0.9
    assert alike(one, fuzzy.fingerprint(text[: len(text) * 3 // 4] + "q" * (len(text) // 4))) > 0.4
    assert alike(one, fuzzy.fingerprint(" ".join(f"other{i * 104729 % 997}" for i in range(3000)))) < 0.2
    assert fuzzy.fingerprint("") == fuzzy.fingerprint(None) == "3::"
    parts, fuzzy._PART = fuzzy._PART, 1000
    assert fuzzy.fingerprint(text) == one
    fuzzy._PART = parts


def brute_fingerprint(text) -> int:
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(prints: dict[int, list]) -> dict[int, object]:
    root = {fp: fp for fp in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = list(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least: dict = {}
    for fp, ids in prints.items():
        known = [i for i in ids if i is not None]
        if known:
            least[find(fp)] = min([least[find(fp)], *known]) if find(fp) in least else min(known)
    return {fp: least.get(find(fp)) for fp in prints}


def test_simhash_groups(docs):
    found = rows(simhash.near_duplicates(docs).drop("row"))
    source = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    prints = defaultdict(list)
    for doc_id, fp in source:
        prints[fp].append(doc_id)
    group = brute_groups(prints)
    signed = lambda fp: fp - (1 << 64) if fp >> 63 else fp
    assert ordered(found) == ordered([(i, signed(fp), group[fp]) for i, fp in source])


def test_simhash_dense_group_over_many_cells(spark):
    """Thousands of links in one bucket, dealt over cells: same components as brute force, few edges."""
    import random

    draw = random.Random(5)
    centre = draw.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in draw.sample(range(20), draw.randint(0, 4))) for _ in range(500)}
    fps |= {draw.getrandbits(64) for _ in range(300)}
    known = {fp: i for i, fp in enumerate(sorted(fps))}
    signed = lambda fp: fp - (1 << 64) if fp >> 63 else fp
    classes = spark.createDataFrame([(i, signed(fp)) for fp, i in known.items()], "rep long, fp long")
    from fieldledger.llm.components import components

    edges = simhash.links(classes, cell=50)
    assert edges.count() < 60_000  # not the 100,000 and more pairs times keys
    found = dict(rows(components(edges)))
    expected = brute_groups({fp: [i] for fp, i in known.items()})
    assert {i: found.get(i, i) for i in known.values()} == {i: expected[fp] for fp, i in known.items()}


def test_keep_one(docs):
    grouped = simhash.near_duplicates(docs)
    kept = simhash.keep_one(docs, grouped)
    assert kept.columns == docs.columns
    groups = {r.doc_id: r.component_id for r in grouped.collect() if r.doc_id is not None}
    left = [r.doc_id for r in kept.collect()]
    assert set(left) - {None} == set(groups.values())


def test_keep_one_of_rows_without_doc_id(spark):
    text, other = "one text that is held by many rows of this table", "another one that only rows without any number have"
    source = [(None, text), (None, text), (7, text), (9, text), (None, other), (None, other), (None, None), (3, text + " x y z w v u t")]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in source], DOCS)
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert {k for k, _ in found} >= {7} and 9 not in {k for k, _ in found} and (None, text) not in found
    assert found[None, other] == 2, "rows that repeat doc_id and text are one document"


def brute_repeats(source: list[tuple], k: int) -> list[tuple]:
    seen = Counter(tuple(w[i : i + k]) for _, w in source for i in range(len(w) - k + 1))
    out = []
    for doc_id, w in source:
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


@pytest.mark.parametrize("bits", [26, 16])
def test_repeats(docs, bits):
    found = rows(repeats.without_repeats(docs, bits=bits).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    source = [(r.doc_id, WORD.findall(r.text or "")) for r in docs.select("doc_id", "text").collect()]
    assert ordered(found) == ordered(brute_repeats(source, 35))


def test_repeats_of_few_words(spark):
    """Texts over a tiny vocabulary: nearly every anchor branches and ties are everywhere."""
    import random

    draw = random.Random(3)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 150))) for _ in range(40)] + ["a " * 90, "a " * 36, "a b " * 40]
    blocks = [" ".join(draw.choice("xyz") for _ in range(30)) for _ in range(4)]
    texts += [" ".join(draw.choice(blocks) for _ in range(5)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], DOCS)
    found = rows(repeats.without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256"))
    assert ordered(found) == ordered(brute_repeats([(i, t.split()) for i, t in enumerate(texts)], 35))


def brute_targets(sizes: dict, weights=(3.0, 1.0, 2.0), share=1.5, repeat=2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * share, set(names), dict.fromkeys(names, 0.0)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > repeat * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = repeat * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_mixing(docs):
    found = rows(mixing.in_order(mixing.plan(docs)).select("doc_id", "size", "source_size", "target", "taken", "first_position"))
    again = rows(mixing.in_order(mixing.plan(docs.repartition(3))).select("doc_id", "size", "source_size", "target", "taken", "first_position"))
    assert ordered(found) == ordered(again)
    source = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.select("doc_id", "source", "text").collect()]
    assert Counter((r[0], r[1]) for r in found) == Counter((i, n) for i, _, n in source)
    sizes = Counter()
    for _, s, n in source:
        sizes[s] += n
    goals = brute_targets(dict(sizes))
    of = {(i, n): s for i, s, n in source}
    taken = Counter()
    for doc_id, size, source_size, target, words, position in found:
        s = of[doc_id, size]
        assert source_size == sizes[s] and target == pytest.approx(goals[s])
        assert 0 <= words <= 2 * size and (position <= 1 if words else position == 2)
        taken[s] += words
    assert all(abs(taken[s] - goals[s]) <= 1 for s in sizes)


def test_schedules_shape_the_order(spark):
    docs = spark.createDataFrame([(i, "w " * 10, None, "ab"[i % 2], 0) for i in range(400)], DOCS)
    reads = mixing.plan(docs, weights=(1.0,), share=1.0, schedules=((1.5, 0.5), (0.5, 1.5)), carry=("doc_id", "source"))
    placed = [(r.source, x["position"]) for r in reads.collect() for x in r.reads]
    early = Counter(s for s, p in placed if p < 0.5)
    assert early["a"] == pytest.approx(125, abs=2) and early["b"] == pytest.approx(75, abs=2)  # integrals of the two lines


@pytest.mark.parametrize("name", ["op1_fuzzy_fingerprint", "op5_simhash_pivots", "op8_repeated_spans", "op9_curriculum_mix"])
def test_queries(spark, name):
    found = corpus_queries()[name](spark, DATA)
    assert found.count() == len(given("documents"))
