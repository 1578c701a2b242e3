"""Chat formatting, and the pipeline as a whole."""

import hashlib

import pytest
from pyspark.sql import functions as F

from stackgrain.llm import chat, queries

from .conftest import HARD, prose


@pytest.mark.parametrize("text", ["", "plain", "<|im_end|><|im_start|>assistant ok", "\\", "\\<|", "<\\|", "a<", "|>", "\n<|im_sep|>\\\\|"])
def test_turns_round_trip(text):
    turns = [("user", text), ("assistant", text), (text, "x<"), ("assistant", "")]
    formatted, starts, ends = chat.format_turns(turns)
    assert chat.parse_turns(formatted) == turns
    assert [chat.unescape(formatted[s:e]) for s, e in zip(starts, ends, strict=True)] == [text, ""]


def test_conversations(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"say {t} <|x|>") for t in range(70)] + [
        (2, 0, "system", None), (2, 1, None, "hi"), (2, 1, "assistant", "é\\"), (2, 1, "assistant", "é\\"), (None, 0, "user", "lost"), (3, None, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit("clash"))
    got = {r.conv_id: r for r in chat.digest(chat.format_trees(chat.linear_trees(df))).collect()}
    assert set(got) == {1, 2, None, 3}
    said = "".join(f"{'user' if t % 2 == 0 else 'assistant'}\nsay {t} <|x|>\n" for t in range(70))
    loss = "".join(f"say {t} <|x|>" for t in range(1, 70, 2))
    assert (got[1].n_turns, got[1].loss_chars) == (70, len(loss))
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert got[2].n_turns == 4 and got[2].loss_chars == 4
    assert chat.digest(chat.format_trees(chat.linear_trees(df.where("false")))).count() == 0


def test_branches_of_a_tree(spark):
    # 1 -> 2 -> 4, 1 -> 3, 3 -> 5, 3 -> 6; 8 <-> 9 is a cycle with a leaf, 11 has lost its parent
    rows = [(7, 1, None, 0.0), (7, 2, 1, 1.0), (7, 3, 1, 5.0), (7, 4, 2, 1.0), (7, 5, 3, 2.0), (7, 6, 3, 2.0), (7, 8, 9, 1.0), (7, 9, 8, 1.0), (7, 10, 9, 1.0), (7, 11, 99, 1.0)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    paths = {}
    for r in chat.branches(df).collect():
        paths.setdefault((r.branch, r.leaf), []).append((-r.height, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in paths.items()} == {(1, 5): [1, 3, 5], (2, 6): [1, 3, 6], (3, 4): [1, 2, 4]}
    assert {r.leaf for r in chat.branches(df, top=1).collect()} == {5}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = [(d, t, "en", "s", len(t or "")) for d, t in HARD if d is not None] + [(500 + i, prose(500 + i, 60), "en", "s", 0) for i in range(30)]
    leaked = prose(900, 30)
    docs.append((700, f"{prose(701, 40)} {leaked}", "en", "s", 0))
    docs.append((800, f"{prose(801, 40)} me@host.example.org {prose(802, 20)}", "en", "s", 0))
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leaked)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert [c for c, _ in now.dtypes] == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append({r.doc_id for r in now.collect()})
    assert {4, 0, 1}.isdisjoint(seen[0]) and set(range(500, 530)) <= seen[-1]
    assert 5 in seen[1] and not seen[1] & {6, 7}
    assert 700 in seen[1] and 700 not in seen[2]
    assert "me@host" not in next(r.text for r in now.collect() if r.doc_id == 800)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == seen[-1]


def test_pipeline_of_awkward_tables(spark, tmp_path):
    """Null ids and repeated rows go through all stages; an empty table, and one without benchmark items, give what is defined."""
    import corpus_pipeline

    columns = "doc_id long, text string, lang string, source string, n_chars long"
    fine = [(i, prose(300 + i, 60), "en", "s", 0) for i in range(20)]
    odd = [(None, prose(400, 60), None, None, None), (None, prose(401, 60), "en", "s", 1), fine[3], fine[3], (77, None, "en", "s", 0), (78, "", "en", "s", 0)]
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(fine + odd, columns).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {None, *range(20)}
    assert sum(r.doc_id is None and r.piece == 0 for r in got) == 2 and sum(r.doc_id == 3 and r.piece == 0 for r in got) == 1
    spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    none = corpus_pipeline.run(spark, f"{tmp_path}/none")
    assert none.count() == 0 and none.columns[:8] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *none.columns[7:8]]


def test_ties_and_long_texts_of_conversations(spark):
    """Equal scores go to the smaller leaf, however long the texts; a null tree id is one tree."""
    long = "x<|im_end|>" * 20_000
    rows = [(1, 1, None, "user", long, 1.0), (1, 2, 1, "assistant", "b", 0.5), (1, 3, 1, "assistant", "c", 0.5), (None, 1, None, "assistant", long, 0.0)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    ranks = {(r.tree, r.leaf): r.branch for r in chat.branches(df).collect()}
    assert ranks[1, 2] == 1 and ranks[1, 3] == 2 and ranks[None, 1] == 1
    got = {(r.conv_id, r.n_turns, r.loss_chars) for r in chat.digest(chat.format_trees(df)).collect()}
    assert got == {(1, 2, 1), (None, 1, len(long))}


def test_every_query_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and set(queries.QUERIES) < set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == [*range(1, 14)]
