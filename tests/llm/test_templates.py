"""Benchmark decontamination against a plain version: word by word, every document against every item."""

import random
import re
from collections import defaultdict

import pytest

from fieldledger.llm import templates as T
from tests.llm.fixtures import awkward, clashing, ordered, rows

OUTER = re.compile(r"^[^\w%€$£]+|[^\w%€$£]+$")
NUMBER = re.compile(r"^[€$£]?[+-]?\d+(?:[.,:/]\d+)*(\D{0,12})$")


def plain_words(text: str):
    """(lower, number, unit word, capitalised, after an end) of each word that is more than marks."""
    out, ended = [], True
    for token in re.findall(r"[^\x20\x09-\x0D]+|\n", text):
        if token == "\n":
            ended = True
            continue
        core = OUTER.sub("", token)
        lower = core.lower()
        if core:
            n = NUMBER.match(core)
            number = bool(n and (not n[1] or n[1].strip() in T.UNITS)) or lower in T.NUMBERS
            capital = not number and len(core) > 1 and core[0].isupper() and any(c.islower() for c in core[1:]) and lower not in T.PLAIN
            out.append((lower, number, not number and lower in T.UNITS, capital, ended))
        ended = bool(re.search(r"[.!?:]\W*$", token))
    return out


def plain_template(text: str, common: set, names: set):
    """(template word, slot or None) in order."""
    out, before = [], False
    for lower, number, unit, capital, ended in plain_words(text):
        if number:
            made = ("#number", f"number {lower}")
        elif unit and before:
            made = ("#unit", f"unit {lower}")
        elif (capital and not ended) or (capital and lower not in common) or lower in names:
            made = ("#name", f"name {lower}")
        else:
            made = (lower, None)
        out.append((*made, lower))
        before = number
    return out


def plain_windows(words, width):
    for i in range(len(words) - width + 1):
        window = words[i : i + width]
        if sum(slot is None for _, slot, _ in window) >= min(T.LITERALS, width):
            yield i, (width, *[w for w, _, _ in window]), [slot for _, slot, _ in window if slot]


def plain_contaminated(docs, items, share=T.MIN_SHARE):
    counts = defaultdict(lambda: [0, 0, 0])
    for _, text in items:
        for lower, number, _, capital, ended in plain_words(text or ""):
            if not number:
                counts[lower][0] += not capital
                counts[lower][1] += capital and not ended
                counts[lower][2] += capital and ended
    common = {w for w, (low, inside, _) in counts.items() if low and low >= inside}
    names = {w for w, (low, inside, opens) in counts.items() if inside > low or (not low and opens)}
    known = {}
    for item_id, text in items:
        words = plain_template(text or "", common, names)
        width = min(8, len(words))
        found = {}
        for at, key, slots in plain_windows(words, width if width >= T.LITERALS else 8):
            found.setdefault(key, (at, slots))
        if not found and words:
            found[("whole", *[w for _, _, w in words])] = (0, [])
        known[item_id, text] = found
    out = []
    for doc_id, text in set(docs):
        words = plain_template(text or "", common, names)
        places = defaultdict(list)
        for width in {len(k) - 1 for f in known.values() for k in f if k[0] != "whole"}:
            for at, key, slots in plain_windows(words, width):
                places[key].append((at, slots))
        if words:
            places[("whole", *[w for _, _, w in words])].append((0, []))
        hits = []
        for (item_id, _), found in known.items():
            diagonals = defaultdict(list)
            for key, (at, slots) in found.items():
                for spot, filled in places.get(key, []):
                    diagonals[spot - at].append((key, list(zip(slots, filled))))
            good = {}
            for windows in diagonals.values():
                pairs = {p for _, ps in windows for p in ps}
                against = {(i, d) for i, d in pairs if any((i == x) != (d == y) for x, y in pairs)}
                same = all(i == d for i, d in pairs)
                for key, ps in windows:
                    if not against & set(ps):
                        good[key] = good.get(key, False) or same
            if good and len(good) >= max(1, -(-len(found) * share // 1)):
                hits.append((len(good) / len(found), item_id, all(good.values())))
        if hits:
            best = min(hits, key=lambda h: (-h[0], h[1] is None, h[1] or 0))
            out.append((doc_id, best[1], best[0], "exact" if best[2] else "reparameterised", len(hits)))
    return out


PEOPLE = ["Anna", "Bob", "Émile", "Zoë", "McDonald", "Lena"]
FILLER = "then the quick brown fox sold many fresh eggs at our small market while every farmer was happy and paid for each box été über señor don't x_y “quoted” naïve".split()


def made(draw: random.Random, n: int) -> list[str]:
    words = []
    for _ in range(n):
        words.append(draw.choice([*FILLER, *FILLER, draw.choice(PEOPLE), str(draw.randint(1, 30)), "three", "12.5", "kg", "$40", "7%", "--", "end."]))
        if draw.random() < 0.05:
            words.append("\n")
    return words


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_every_document_with_every_item(spark, seed):
    draw = random.Random(seed)
    items = [(i, " ".join(made(draw, draw.choice([2, 5, 9, 14, 25, 40])))) for i in range(12)]
    items += [(items[4][0], items[7][1]), (None, items[9][1] + " more words to follow"), (50, None), (51, "  "), (52, "--")]
    changed = [(100 + i, re.sub(r"\b\d+\b", lambda m: str(int(m[0]) + 3), text or "")) for i, (_, text) in enumerate(items[5:9])]  # kin
    items += changed
    docs = []
    for i in range(60):
        base = draw.choice(items)[1] or ""
        words = base.split(" ")
        swap = dict(zip(PEOPLE, draw.sample(PEOPLE, len(PEOPLE))))
        words = [swap.get(w, w) for w in words] if draw.random() < 0.5 else words
        words = [str(int(w) + draw.randint(0, 2)) if w.isdigit() and draw.random() < 0.6 else w for w in words]
        words = [w if draw.random() > 0.04 else draw.choice(FILLER) for w in words]
        text = " ".join(words)
        text = text.lower() if draw.random() < 0.1 else text
        around = [" ".join(made(draw, 6)), " ".join(made(draw, 6))] if draw.random() < 0.7 else ["", ""]
        docs.append((i if draw.random() < 0.9 else None, f"{around[0]} {text} {around[1]}"))
    docs += [docs[0], (docs[1][0], docs[2][1]), (None, None), (70, ""), (71, items[0][1])]
    frames = (spark.createDataFrame(x, f"{key} long, text string") for x, key in ((docs, "doc_id"), (items, "item_id")))
    left, right = frames
    found = [(r.doc_id, r.item_id, round(r.share, 9), r.kind, r.n_items) for r in T.contaminated(clashing(left), right).collect()]
    want = [(d, i, round(s, 9), k, n) for d, i, s, k, n in plain_contaminated(docs, items)]
    assert ordered(found) == ordered(want)
    gone = {(d, t) for d, t in docs for f in [plain_contaminated([(d, t)], items)] if f}
    assert ordered(rows(T.clean(left, right))) == ordered([r for r in docs if r not in gone])


def test_kin_are_matched_once(spark):
    text = "A baker sold {} loaves of bread on the first day and {} loaves of bread on the second day of the fair"
    items = spark.createDataFrame([(i, text.format(i + 100, 2 * i + 301)) for i in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(i, text.format(i + 100, 2 * i + 301)) for i in range(30)], "doc_id long, text string")
    made = T.item_windows(items)
    assert made.select("item").distinct().count() == 40 and T.kindred(made).select("item").distinct().count() == 1
    found = T.contaminated(docs, items).collect()
    assert len(found) == 30 and {(r.item_id, r.n_items) for r in found} == {(0, 40)}


def test_awkward_documents(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, "no id here"), (2, "word"), (3, None), (4, " ".join(f"shared{i}" for i in range(60)))], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in T.contaminated(clashing(docs), items).collect()}
    assert found >= {(None, 1), (9006, 2)} and all(i in (1, 2, 4) for _, i in found)
