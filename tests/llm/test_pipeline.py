"""The pipeline against its stages' brute-force results, and the registration."""

from __future__ import annotations

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import pyarrow as pa

import __spark_entry__
import corpus_pipeline
from tagquality.llm import bpe, langid, linededup, simhash
from tagquality.llm.queries import vocabulary


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)) and "pipeline" in names


def test_stages_keep_columns_and_their_decisions_hold(llm, make, tmp_path):
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "te", "ru") for b in ("n", "s", "ra", "do", "vi")]
    line = lambda k: " ".join(random.Random(k).choices(words, k=14))
    text = lambda k: "\n".join(line(k * 10 + j) for j in range(6))
    item = "one two three four five six seven eight"
    shared = line(99999) + " end"
    rows = [(1, text(1)), (2, text(1)), (3, f"{text(3)}\n{shared}"), (4, f"{text(4)}\n{shared}"), (5, f"{text(5)} {item}"), (6, "123"), (7, None)]
    rows += [(8, text(8)), (9, text(8).replace("ka", "KA")), *[(k, text(k)) for k in range(20, 30)]]
    folder = tmp_path / "in"
    make(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    llm.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, docs, str(folder))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = llm.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert not {6, 7} & set(kept["language_id"])
    assert 2 not in kept["line_dedup"] and kept["line_dedup"][4] == text(4) and shared in kept["line_dedup"][3]
    assert 8 in kept["near_dedup"] and 9 not in kept["near_dedup"]
    assert 5 not in kept["decontamination"]
    clean = {1, 3, 4, 8, *range(20, 30)}
    assert set(kept["decontamination"]) == clean
    got = corpus_pipeline.run(llm, str(folder)).collect()
    assert {r.doc_id for r in got} == clean and all(r.n_tokens > 0 for r in got)


def test_near_dedup_does_not_keep_the_vocabulary_of_an_earlier_stage(make):
    docs = make([(k, f"some words of document {k} and ten more") for k in range(40)]).repartition(4)
    bpe.encode_documents(docs, vocabulary()).collect()

    def held(batches):
        list(simhash._shingles(batches))
        from tagquality.llm import bpe as loaded

        yield pa.RecordBatch.from_arrays([pa.array([loaded.automaton.cache_info().currsize])], names=["n"])

    assert {r.n for r in docs.select("text").mapInArrow(held, "n long").collect()} == {0}


def test_the_transition_table_is_held_once():
    machine = bpe.Automaton(bpe.load_spec(vocabulary()))
    ids = machine.encode("the cats of thermodynamics, unbelievably 1234 " + "ab" * 300)
    rows = machine.table.nbytes
    assert len(ids) and len(machine.states) <= len(machine.table) and rows <= 64 * (machine.size // 8 + 1) * 2
    assert not [k for k, v in vars(machine).items() if isinstance(v, dict) for x in v.values() if isinstance(x, bytes) and len(x) > 4000]


def test_line_dedup_and_language_id_do_not_keep_the_vocabulary_of_an_earlier_run(make):
    docs = make([(k, f"some words of document {k} and ten more of them\nand a line") for k in range(40)]).repartition(4)
    rows = linededup._keyed(docs.select("doc_id", "text"))
    sample = docs.selectExpr("lang", "doc_id AS h", "text")
    for stage, inputs in ((linededup._line_rows(10, True), rows), (langid._sample_windows, sample)):
        bpe.encode_documents(docs, vocabulary()).collect()

        def held(batches, stage=stage):
            list(stage(batches))
            from tagquality.llm import bpe as loaded

            yield pa.RecordBatch.from_arrays([pa.array([loaded.automaton.cache_info().currsize])], names=["n"])

        assert {r.n for r in inputs.mapInArrow(held, "n long").collect()} == {0}
