"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline
from conftest import SMALL
from rainledger.sinks.staging import stage
from test_llm_operators import WORD, brute_components, brute_words


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)
    good = stage(steps["quality rules"](spark, docs, SMALL), "t")
    assert good.columns == columns and 0 < good.count() < docs.count()
    first = stage(steps["near duplicates"](spark, good, SMALL), "t")
    texts = [(r["doc_id"], r["text"]) for r in good.orderBy("doc_id").collect()]
    wanted = {doc for doc, (_, component) in brute_components(texts).items() if doc == component}
    assert first.columns == columns and {r["doc_id"] for r in first.collect()} == wanted
    cut = stage(steps["substring dedup"](spark, first, SMALL), "t")
    before = {doc: text for doc, text in texts if doc in wanted}
    kept, after = brute_words(sorted(before.items())), {r["doc_id"]: r["text"] for r in cut.collect()}
    assert cut.columns == columns and {d: " ".join(WORD.findall(t)) for d, t in after.items()} == {d: k for d, (_, _, k) in kept.items()}
    assert all(after[d] == before[d] for d, (_, gone, _) in kept.items() if not gone) and any(after[d] != before[d] for d in after)
    assert cut.filter("n_chars <> char_length(text)").count() == 0
    packed = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in steps["best-fit packing"](spark, cut, SMALL).collect()}
    assert packed == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SMALL).collect()}


def test_cut_passages_leave_the_layout(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    code = "def f():\n    return 1\n\nx  y\t\n"
    rows = [(1, passage), (2, code), (3, f"  a\n{passage}\n\n  b  c\n"), (4, f"z\n  {passage}\n"), (5, f"\n{passage} "), (6, None), (7, ""), (8, f"{passage} x {passage}")]
    df = spark.createDataFrame([(i, t, 3, "s") for i, t in rows], "doc_id long, text string, n_chars int, q string")
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeated_passages(spark, df, "").collect()}
    wanted = {1: passage, 2: code, 3: "  a\nb  c\n", 4: "z\n", 5: "\n ", 7: "", 8: "x"}
    assert found == {i: (t, len(t)) for i, t in wanted.items()} | {6: (None, 3)}
    bare = df.select("doc_id", "text")
    assert {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, bare, "").collect()} == wanted | {6: None}
    assert corpus_pipeline.repeated_passages(spark, df.limit(0), "").count() == 0


def test_stages_on_awkward_and_empty_tables(spark):
    prose = " ".join(f"word{i} of a plain text" for i in range(30))
    rows = [(1, prose), (1, prose), (None, prose + " tail"), (2, None), (3, ""), (4, " \n\t "), (5, "tie"), (6, prose + "\n" + prose)]
    docs = spark.createDataFrame([(i, t, None if n % 2 else "en", None, n, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, _id int")
    for frame in (docs, docs.limit(0)):
        for _, step in corpus_pipeline.STAGES:
            out = stage(step(spark, frame, SMALL), "t")
            if step is not corpus_pipeline.pack:
                assert out.columns == docs.columns
                frame = out
        assert (out.count() > 0) == (frame.count() > 0)
