"""Line dedup, SimHash and decontamination against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
import xxhash

from tagquality.llm import common, decontaminate, linededup, simhash
from tagquality.llm.common import components

RNG = random.Random(7)
WORDS = ["ta", "po", "ke", "li", "mu", "ra", "so", "ne"]


def sentence(n: int) -> str:
    return " ".join(RNG.choices(WORDS, k=n))


def brute_whole(rows, least):
    """Every run of enough words counts, each extended to its maximum."""
    seen, out = set(), {}
    for doc, text in rows:
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if x.split()]
        gone = set()
        for i in range(len(at)):
            for j in range(i, len(at)):
                if sum(len(lines[k].split()) for k in at[i : j + 1]) >= least:
                    key = tuple(lines[k].strip() for k in at[i : j + 1])
                    gone |= set(at[i : j + 1]) if key in seen else set()
                    seen.add(key)
        out[doc] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_lines_equal_brute_force(make):
    pool = [sentence(RNG.randint(1, 7)) for _ in range(12)] + ["", "  "]
    rows = [(k, "\n".join(RNG.choices(pool, k=RNG.randint(1, 14)))) for k in range(60)]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(make(rows)).collect()}
    assert got == brute_whole(rows, linededup.MIN_WORDS)


def test_lines_of_odd_rows(make):
    long = "\n".join(sentence(12) for _ in range(300))
    rows = [(1, long), (2, long), (3, None), (4, ""), (None, long), (6, sentence(4)), (6, sentence(4)), (1, long)]
    found = linededup.dedup_lines(make(rows))
    assert found.columns[-2:] == ["n_lines", "n_removed"] and found.columns[:8] == make([]).columns
    got = found.collect()
    kept = sorted(((r.doc_id, r.n_removed) for r in got if r.n_lines == 300), key=str)
    assert kept == [(1, 0), (1, 0), (2, 300), (None, 300)]
    assert [r.text for r in got if r.doc_id == 3] == [None]
    assert linededup.dedup_lines(make([])).collect() == []


def test_lines_of_hot_runs_and_repeated_rows(make, monkeypatch):
    monkeypatch.setattr(linededup, "CHUNK", 3)
    hot, other = sentence(12), "\n".join(sentence(4) for _ in range(5))
    rows = [(k, f"{sentence(11)} {k}\n{hot}\n{other}") for k in range(40)]
    got = linededup.dedup_lines(make(rows * 7)).collect()
    want = brute_whole(rows, linededup.MIN_WORDS)
    assert len(got) == 7 * len(rows) and all(r.text == want[r.doc_id] for r in got)


def test_whole_runs_go_to_their_last_line(make):
    rng = random.Random(11)
    words = lambda n: " ".join(rng.choices(WORDS, k=n))
    shared = "\n".join([words(13), words(13), words(5)])
    rows = [(1, f"{shared}\nfirst one"), (2, f"{shared}\nsecond"), (3, f"third\n{shared}")]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(make(rows)).collect()}
    assert got == {1: rows[0][1], 2: "second", 3: "third"}


@pytest.mark.parametrize("least", [10, 7])
def test_whole_runs_equal_brute_force(make, least):
    rng = random.Random(13)
    pool = [" ".join(rng.choices(WORDS, k=rng.choice([1, 1, 2, 3, 5, 8, 12]))) for _ in range(14)] + ["", "  "]
    rows = []
    for k in range(80):
        lines = rng.choices(pool, k=rng.randint(1, 14))
        if rows and rng.random() < 0.6:  # a passage of an earlier document amid other lines
            other = rng.choice(rows)[1].split("\n")
            lines[rng.randint(0, len(lines)) :] = [*other[rng.randrange(len(other)) :], f"own {k}", *lines[:3]]
        rows.append((k, "\n".join(lines)))
    got = {r.doc_id: r.text for r in linededup.dedup_lines(make(rows), least).collect()}
    assert got == brute_whole(rows, least)


def brute_print(text: str) -> int:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0d]+", low)
    parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force():
    texts = ["", " \t", "A", "É b", "a b c", "a b c a b c a b c", "x\x1cy z\x0bw q", sentence(500)]
    texts += [sentence(RNG.randint(1, 9)) for _ in range(50)]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [brute_print(t) for t in texts]


def linked(fps):
    near = [{j for j, y in enumerate(fps) if (x ^ y).bit_count() <= 3} for x in fps]
    roots = {}
    for k in range(len(fps)):
        todo = [] if k in roots else [k]
        while todo:
            at = todo.pop()
            if roots.setdefault(at, k) == k:
                todo += [j for j in near[at] if j not in roots]
    return roots


@pytest.mark.parametrize("bits", [(8,), (16,)])
def test_links_equal_brute_force(llm, monkeypatch, bits):
    monkeypatch.setattr(simhash, "BUCKET_BITS", bits)
    monkeypatch.setattr(simhash, "BLOCK", 3)
    base = [RNG.getrandbits(64) for _ in range(12)]
    fps = set(base) | {0}
    for x in base:
        for _ in range(25):  # chains and tight groups of one, two, three and four bits
            x ^= sum(1 << b for b in RNG.sample(range(64), RNG.randint(1, 4)))
            fps.add(x)
    fps = sorted(fps)
    rows = llm.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = {r.node: r.root for r in components(simhash.links(rows)).collect()}
    got = [found.get(v := int(np.uint64(f).astype(np.int64)), v) for f in fps]
    want = linked(fps)
    assert len({(got[k], want[k]) for k in range(len(fps))}) == len(set(got)) == len(set(want.values()))


def test_components_of_a_chain(llm):
    edges = llm.createDataFrame([(k, k + 1) for k in range(60)] + [(7, 7), (100, 101)], "a long, b long")
    found = components(edges).collect()
    assert len({r.root for r in found if r.node < 100}) == 1 and len(found) == 63
    assert components(edges.limit(0)).collect() == []


def test_components_that_one_task_holds_take_one_table(llm, monkeypatch):
    names = []
    monkeypatch.setattr(common, "written", lambda df, name, f=common.written: [names.append(name), f(df, name)][1])
    rows = components(llm.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 800), (7, 7)], "a long, b long")).collect()
    assert len(rows) == 303 and len({r.root for r in rows}) == 2
    assert names == ["edges"]


def test_components_of_many_tasks_equal_brute_force(llm, monkeypatch):
    monkeypatch.setattr(common, "EDGES_HELD", 50)
    edges = [(RNG.randrange(-500, 500), RNG.randrange(-500, 500)) for _ in range(450)]
    root = {k: k for e in edges for k in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.node: r.root for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    finally:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found.keys() == root.keys() and set(found.values()) <= root.keys()
    assert len({(found[k], root[k]) for k in root}) == len(set(found.values())) == len(set(root.values()))


def test_near_duplicates_of_odd_rows(make):
    text = sentence(200)
    rows = [(5, text), (3, text), (3, text), (None, text), (9, None), (8, ""), (7, "one two")]
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(make(rows)).collect()}
    mark = f"{brute_print(text):016x}"
    assert got >= {(5, mark, 3), (3, mark, 3), (None, mark, 3), (9, "0" * 16, 8), (8, "0" * 16, 8)}
    kept = simhash.drop_near_duplicates(make(rows))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8] and kept.columns == make([]).columns
    assert simhash.near_duplicates(make([])).collect() == []
    assert [r.doc_id for r in simhash.drop_near_duplicates(make([(None, text)])).collect()] == [None]
    two = simhash.drop_near_duplicates(make([(5, text), (5, sentence(150)), (4, text)])).collect()
    assert sorted(r.doc_id for r in two) == [4, 5]


def five_words(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
    return {" ".join(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else {" ".join(words)} - {""}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(words, n, rng):
    """The words with n of them replaced, dropped or doubled."""
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[f"new{rng.randrange(9999)}"], [], [words[k], words[k]]])
    return words


def test_near_groups_hold_pairs_of_five_word_likeness(llm):
    rng = random.Random(17)
    pool = [f"w{k}" for k in range(3000)]
    texts = [None, "", " \n", "one two", "ONE two", "a b c d e", "a b c d e f"]
    for _ in range(120):
        words = rng.choices(pool, k=rng.choice([12, 60, 150, 400]))
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            texts.append("\n".join(changed(words, rng.randint(0, max(1, len(words) // 25)), rng)))
    long = rng.choices(pool, k=120_000)
    texts += [" ".join(long), " ".join(changed(long, 500, rng)), " ".join(rng.choices(pool, k=120_000))]
    rows = llm.createDataFrame(list(enumerate(texts)), "row long, text string").selectExpr("row", "row + 1000 AS id", "text")
    root = {r["row"]: r["root"] for r in simhash.near_groups(rows).collect()}
    sets = [five_words(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if likeness(sets[i], sets[j]) >= 0.8]
    unequal = [(i, j) for i, j in pairs if sets[i] != sets[j]]
    assert len(unequal) > 60
    assert np.mean([root[i] == root[j] for i, j in unequal]) >= 0.9
    assert all(root[i] == root[j] for i, j in pairs if sets[i] == sets[j])
    # Nothing is in a group that pairs do not lead to.
    nodes = linked_by(len(texts), pairs)
    assert all(nodes[i] == nodes[j] for i in root for j in root if root[i] == root[j])


def linked_by(n, pairs):
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
        if before == root:
            return root
    return root


def test_no_pair_of_five_word_likeness_is_lost(llm, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 2)
    monkeypatch.setattr(simhash, "COUNTED_ROWS", 1)
    rng = random.Random(23)
    hot = [f"h{k}" for k in range(8)]  # a passage that most texts hold
    texts = []
    for k in range(150):
        words = [f"w{rng.randrange(9999)}" for _ in range(rng.choice([9, 40, 120]))] + (hot if k % 3 else [])
        texts += [" ".join(words)] + [" ".join(changed(words, max(1, len(words) // 45), rng)) for _ in range(2)]
        texts.append(" ".join([*words, *[f"x{rng.randrange(9999)}" for _ in range(round((len(words) - 4) / 4))]]))
    rows = llm.createDataFrame(list(enumerate(texts)), "row long, text string").selectExpr("row", "row AS id", "text")
    root = {r["row"]: r["root"] for r in simhash.near_groups(rows).collect()}
    sets = [five_words(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if likeness(sets[i], sets[j]) >= 0.8]
    assert sum(likeness(sets[i], sets[j]) < 0.83 for i, j in pairs) > 40
    assert [p for p in pairs if root[p[0]] != root[p[1]]] == []
    nodes = linked_by(len(texts), pairs)
    assert all(len({root[k] for k in range(len(texts)) if nodes[k] == n}) == 1 for n in set(nodes))
    assert len(set(root.values())) == len(set(nodes))


def test_a_large_family_of_near_copies_makes_few_pairs(llm, monkeypatch):
    rng = random.Random(19)
    words = [f"w{k}" for k in rng.choices(range(5000), k=300)]
    texts = [" ".join(changed(words, rng.randint(1, 4), rng)) for _ in range(400)] + [" ".join(rng.choices(words, k=300)) for _ in range(50)]
    rows = llm.createDataFrame(list(enumerate(texts)), "row long, text string").selectExpr("row", "row AS id", "text")
    compared, real = [], simhash.alike

    def counting(pairs, held):
        compared.append(pairs.count())
        return real(pairs, held)

    monkeypatch.setattr(simhash, "alike", counting)
    root = {r["row"]: r["root"] for r in simhash.near_groups(rows).collect()}
    # Far fewer pairs are compared by their shingles than the 80,000 of the family.
    assert sum(compared) <= 10 * 400
    assert len({root[k] for k in range(400)}) <= 8 and len({root[k] for k in range(400, 450)}) == 50
    sets = simhash.shingle_hashes([t.encode() for t in texts])
    signed = [(k, *map(int, simhash.signature(s).view(np.int64))) for k, s in enumerate(sets)]
    classes = llm.createDataFrame(signed, "node long, s0 long, s1 long, s2 long, s3 long")
    assert simhash.near_pairs(classes).count() < 100 * 400


def brute_contained(docs, items):
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    grams = lambda w, k: {" ".join(w[j : j + k]) for j in range(len(w) - k + 1)}
    found = set()
    for i, text in items:
        words = split(text)
        own = grams(words, k := min(5, len(words))) if words else set()
        for d, doc in docs:
            shared = len(own & grams(split(doc), k)) if own else 0
            if own and shared >= math.ceil(round(0.8 * len(own), 6)):
                found.add((d, i, len(own), shared))
    return found


def test_contained_equals_brute_force(llm, make):
    items = [(k, sentence(RNG.choice([1, 3, 4, 5, 6, 14, 30]))) for k in range(25)] + [(90, None), (91, ""), (92, "...")]
    docs = []
    for k in range(40):
        part = RNG.choice(items[:25])[1].split()
        if RNG.random() < 0.5:
            part[RNG.randrange(len(part))] = "Changed,"
        docs.append((k, f"{sentence(3)}. {' '.join(part).upper()}!\n{sentence(40)}"))
    docs += [(100, None), (101, ""), (None, items[24][1]), (5, docs[5][1])]
    bench = llm.createDataFrame([(*i, 1) for i in items], "item_id long, text string, size int")
    rows = decontaminate.contained(make(docs), bench).collect()
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in rows}
    assert got == brute_contained(docs, items) and len(rows) == len(got)
    kept = decontaminate.decontaminate(make(docs), bench)
    assert kept.columns == make([]).columns
    held = {d for d, *_ in got}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - held


def test_contained_without_rows(llm, make):
    none = llm.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained(make([(1, "a b c d e")]), none).collect() == []
    assert decontaminate.contained(make([]), none).collect() == []
    assert decontaminate.decontaminate(make([(1, "a")]), none).count() == 1
