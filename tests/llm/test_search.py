"""Licence scans, centroid clustering and phrase mining against plain versions of their definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tagquality.llm import centroids, licenses, phrases

RNG = random.Random(5)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Licences


def licence_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base_places(text: str | None) -> dict[str, list[int]]:
    words, found = licence_words(text), {}
    for template in licenses.BASE:
        want = template.text.split()
        at = [k for k in range(len(words)) if words[k : k + len(want)] == want]
        if at:
            found[template.label] = at
    return found


def test_base_phrases_equal_a_plain_search(make):
    parts = ["GNU", "General", "Public", "License", "apache", "CC", "by", "MIT", "é", "x1", "\x00", "-", "\n", "\x85", "K"]
    rows = [(None, None), (1, ""), (2, "MIT License"), (2, "MIT License"), (3, "cc-BY cc by\x7fCC\tby"), (4, "mit licensé mit  license")]
    rows += [(k, " ".join(RNG.choices(parts, k=RNG.randint(0, 60)))) for k in range(10, 150)]
    rows += [(500, "gnu general public license " * 20_000)]
    got = [tuple(r)[:6] for r in licenses.scan(make(rows)).collect()]
    want = []
    for doc, text in rows:
        found = base_places(text)
        at = sorted(x for places in found.values() for x in places)
        ends = (at[0], at[-1]) if at else (None, None)
        want.append((doc, len(licence_words(text)), len(at), *ends, ",".join(sorted(found))))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan(make([])).collect() == []


def test_texts_of_licences_are_found_where_their_key_phrases_stand(make):
    by_label = {t.label: t for t in licenses.ADDED}
    filler = "lorem ipsum dolor sit amet consectetur "
    mit = by_label["mit-text"].text
    rows = [
        (1, filler * 30 + mit + filler * 30),
        (2, mit.replace("free of charge", "for a fee")),
        (3, mit.replace("merge, publish,", "merge and").replace("documentation files", "files")),
        (4, " ".join(reversed(mit.split()))),
        (5, filler * 50),
        (6, by_label["apache-2.0-text"].text + by_label["bsd-text"].text),
    ]
    got = {r.doc_id: r for r in licenses.scan(make(rows)).collect()}
    assert got[1].labels == "mit-text" and got[1].score == pytest.approx(1)
    assert got[2].labels == "" and got[2].score == 0
    assert got[3].labels == "mit-text" and 0.8 < got[3].score < 1
    assert got[4].labels == "" and got[5].labels == ""
    assert got[6].labels == "apache,apache-2.0,apache-2.0-text,bsd-text" and got[6].base_labels == "apache"


def test_document_frequencies_count_each_document_once(make):
    df, total = licenses.document_frequencies(make([(1, "mit mit"), (2, "MIT cc"), (3, None)]), licenses.BASE)
    assert (total, df[b"mit"], df[b"cc"], df[b"gnu"]) == (3, 2, 1, 0)


def test_score_is_that_of_a_plain_search():
    templates = [t for t in licenses.ADDED if t.phrases]
    index = licenses.Index(templates, {b"the": 90, b"license": 50, b"copy": 7}, 100)
    for _ in range(60):
        template = RNG.choice(templates)
        words = licence_words(template.text)
        for _ in range(RNG.randint(0, 25)):
            words[RNG.randrange(len(words))] = "other"
        text = ["x"] * RNG.randint(0, 40) + words + ["license"] * RNG.randint(0, 5)
        _, scores = index.scan([w.encode() for w in text])
        want = {t: plain_score(index, t, text) for t in range(len(templates))}
        assert scores == pytest.approx({t: s for t, s in want.items() if s >= licenses.LEAST_SCORE})


def plain_score(index: licenses.Index, t: int, text: list[str]) -> float:
    """The same definition, by trying every bin of every offset."""
    template = licence_words(index.templates[t].text)
    name = {k: w.decode() for w, k in index.ids.items()}
    rare = [name[w] for w, _ in index.postings[t]]
    votes: dict[int, set[str]] = {}
    for i, w in enumerate(text):
        for j, v in enumerate(template):
            if v == w and w in rare:
                b = (i - j) // licenses.SLACK
                votes.setdefault(b, set()).add(w)
                votes.setdefault(b - 1, set()).add(w)
    best = 0.0
    weight = lambda ws: sum(index.idf[index.ids[w.encode()]] for w in ws)
    for b, who in votes.items():
        if len(who) < min(licenses.AGREE, len(rare)):
            continue
        stretch = range(max(0, (b - 1) * licenses.SLACK), (b + 3) * licenses.SLACK + len(template))
        stands = lambda p: any(text[k : k + len(p)] == p for k in stretch)  # noqa: B023, E731
        if all(stands(licence_words(p)) for p in index.templates[t].phrases):
            here = set(text[stretch.start : stretch.stop])
            best = max(best, weight(w for w in dict.fromkeys(template) if w in here) / weight(dict.fromkeys(template)))
    return best


# Centroids


def plain_clusters(rows: list[tuple], size: int, count: int, rounds: int) -> list[tuple]:
    kept = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    middle = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:count]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((far(v, c), k) for k, c in enumerate(middle))
    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        middle = [
            [math.floor(Fraction(sum(x), len(x))) for x in zip(*groups[k], strict=True)] if k in groups else c
            for k, c in enumerate(middle)
        ]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    mine = Counter()
    for _, k, d in found:
        mine[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return [(i, k, d, mine[k], sum(mine.values()), digest[k]) for i, k, d in found]


VECTORS = "vec_id long, embedding array<float>, label int, v string, cluster string"


def vectors_of(llm, rows):
    return llm.createDataFrame([(i, v, 0, "v", "c") for i, v in rows], VECTORS)


@pytest.mark.parametrize("spread", [1.0, 0.003])
def test_clusters_equal_plain_rounds(llm, spread):
    as_float = lambda x: float(np.float32(x))
    rows = [(k, [as_float(RNG.gauss(0, spread)) for _ in range(6)]) for k in range(200)]
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (900, [0.0] * 6), (901, [0.0] * 6), (902, [-as_float(0.1)] * 6)]
    rows += [(910, None), (911, [0.0] * 5), (912, [0.0] * 7), (913, [0.0] * 5 + [None]), (914, [float("nan")] * 6), (915, [float("-inf")] * 6), (916, [])]
    got = [tuple(r) for r in centroids.cluster(vectors_of(llm, rows).repartition(3), dimensions=6, rounds=4).collect()]
    assert sorted(got, key=str) == sorted(plain_clusters(rows, 6, 8, 4), key=str)


def test_few_equal_or_no_vectors(llm):
    rows = [(k, [0.25, -0.75]) for k in range(20)]
    got = [tuple(r) for r in centroids.cluster(vectors_of(llm, rows), dimensions=2, rounds=2).collect()]
    assert sorted(got) == sorted(plain_clusters(rows, 2, 8, 2))
    assert centroids.cluster(vectors_of(llm, []), dimensions=2).collect() == []
    assert centroids.cluster(vectors_of(llm, [(1, None)]), dimensions=2).collect() == []
    assert len(centroids.cluster(vectors_of(llm, rows[:3]), dimensions=2).collect()) == 3


def test_components_past_the_bound_are_an_error(llm):
    with pytest.raises(PySparkException, match="after scaling"):
        centroids.cluster(vectors_of(llm, [(1, [1e30, 0.0])]), dimensions=2).collect()


def test_search_is_exact_for_any_centroids():
    rng = np.random.default_rng(1)
    for scale in (3, 1000, 1 << 26):
        for count in (1, 2, 40):
            middle = rng.integers(-scale, scale, (count, 5))
            middle[count // 2] = middle[0]
            x = np.concatenate([rng.integers(-scale, scale, (300, 5)), middle])
            number, best = centroids.Search(middle).nearest(x)
            every = ((x[:, None] - middle[None]) ** 2).sum(axis=2)
            assert (best == every.min(axis=1)).all() and (number == every.argmin(axis=1)).all()


# Phrases


def plain_collocations(rows: list[tuple], least: int, top: int) -> list[tuple]:
    seen: dict[str, Counter] = {}
    words_in = Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_in[lang] += len(words)
            for m in range(1, 5):
                seen.setdefault(lang, Counter()).update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in seen.items():
        good = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        ranked = []
        for p, a in good.items():
            cut = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in good.items() if len(q) > len(p)
            )
            if not inside:
                ranked.append((-cut[0], -a, " ".join(p).encode(), f[p[: cut[1]]], f[p[cut[1] :]]))
        for k, (score, a, text, l, r) in enumerate(sorted(ranked)[:top]):
            out.append((lang, k + 1, text.decode(), -a, l, r, words_in[lang], -score))
    return sorted(out)


PHRASES = "doc_id long, text string, lang string, f string, size int, part string"


def phrase_rows() -> list[tuple]:
    words = ["a", "b", "C", "dé", "東", "e-f", "g\x00", "\x85", "h\x1f"]
    ends = [" ", "  ", "\t", ". ", "\n", ",", "\x0b", " ; "]
    rows = [(None, None, None), (None, "", "en"), (3, "...", "fr"), (4, "a b a b", None), (4, "a b a b", "und"), (5, "�a b", "en")]
    for k in range(120):
        text = "".join(w + RNG.choices(ends, [60, 5, 5, 5, 5, 5, 5, 5])[0] for w in RNG.choices(words, range(9, 0, -1), k=RNG.randint(0, 60)))
        rows.append((k, text, RNG.choice(["en", "en", "fr", None])))
    return rows + [(200, "a b a b " * 500, "en"), (201, "x y z w v " * 30, "de")]


def test_collocations_equal_plain_counts(llm):
    rows = phrase_rows()
    # Texts of several slices, one with a word as long as a slice.
    rows += [(300, " ".join(RNG.choices(["so", "it", "goes."], k=90_000)), "en"), (301, "so it " + "q" * phrases.SLICE + " so it" * 9, "en")]
    assert any(len(r[1] or "") > phrases.SLICE for r in rows)
    docs = llm.createDataFrame([(*r, "f", 1, "p") for r in rows], PHRASES).repartition(3)
    for least, top in ((5, 2000), (12, 7)):
        found = phrases.collocations(docs, least, top)
        assert sorted(tuple(r)[:8] for r in found.collect()) == plain_collocations(rows, least, top)


PIECES, SPLIT = r"[.,;:!?\x0A-\x0D]", r"[^\x20\x09]+"


def has(text, phrase):
    pieces = re.split(PIECES, text.translate(LOWER))
    return any(f" {phrase} " in f" {' '.join(re.findall(SPLIT, p))} " for p in pieces)


def test_pointers_lead_to_the_phrase(llm):
    rows = [r for r in phrase_rows() if r[0] is not None and r[1]]
    docs = llm.createDataFrame([(*r, "f", 1, "p") for r in rows], PHRASES)
    for r in phrases.collocations(docs, 10).collect():
        assert r.doc_id == min(i for i, t, lang in rows if (lang or "und") == r.lang and has(t, r.phrase))


def test_phrases_of_empty_tables(llm):
    assert phrases.collocations(llm.createDataFrame([], PHRASES)).collect() == []
    assert phrases.collocations(llm.createDataFrame([(1, None, None, "f", 1, "p")], PHRASES)).collect() == []


def test_slices_hold_every_phrase_once():
    for size in (1, 7, 30):
        for _ in range(200):
            raw = "".join(RNG.choices("abc  \n", k=RNG.randint(0, 120))).encode()
            got = Counter()
            for part, lead in phrases.slices(raw, size):
                place = 0
                for piece in part.split(b"\n"):
                    words = piece.split()
                    for m in range(1, 5):
                        got.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1) if place + i + m - 1 >= lead)
                    place += len(words)
            want = Counter()
            for piece in raw.split(b"\n"):
                words = piece.split()
                for m in range(1, 5):
                    want.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
            assert got == want


def test_colliding_fingerprints_do_not_change_counts(llm, monkeypatch):
    """With fingerprints of a few bits, everything collides."""
    real = phrases.Block.prints
    monkeypatch.setattr(phrases.Block, "prints", lambda self, size, seeds: real(self, size, seeds) & np.uint64(7 << 61))
    rows = phrase_rows()[:40]
    seeds = np.arange(len(rows)).astype(np.uint64)
    assert len(np.unique(phrases.Block([(r[1].encode(), 0, k) for k, r in enumerate(rows) if r[1]]).prints(1, seeds))) <= 8
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist(
        [{"doc_id": r[0], "lang": r[2] or "und", "text": r[1] or "", "seed": 1} for r in rows],
        schema=pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.string()), ("seed", pa.int64())]),
    )
    every = phrases.Field(13, np.full(1 << 7, ~np.uint64(0)))

    class Sent:
        value = {1: every, 2: every, 3: every}

    got = Counter()
    for out in phrases._verifier(Sent)(iter([batch])):
        for r in out.to_pylist():
            if r["size"]:
                got[r["lang"], r["phrase"]] += r["count"]
    want = Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                want.update((lang or "und", " ".join(words[i : i + m])) for i in range(len(words) - m + 1))
    assert got == want
