"""The stages of the pipeline on small tables with null and repeated ids."""

import hashlib
import random

import corpus_pipeline
from vigia.llm import line_dedup, sentencepiece_codec, toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)


def run(spark, name, rows):
    table = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], SCHEMA)
    out = STAGE[name](spark, table.repartition(3), SF)
    return out, sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) if "text" in out.columns else out.collect()


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_near_dedup_keeps_one_text_of_each_class(spark):
    rng = random.Random(1)
    groups = []
    for ids in ([None, None, None], [4, 4], [None, 7, 3], [9], [None]):
        base = words(rng, 200)
        groups.append([(i, " ".join([*base, f"end{k}"])) for k, i in enumerate(ids)])
    groups.append([(11, "copies of " + groups[0][0][1][::-1])] * 2)
    order = lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).digest())
    want = [min(g, key=order) for g in groups] + [(20, None), (None, None)]
    out, got = run(spark, "minhash_near_dedup", [r for g in groups for r in g] + [(20, None), (None, None)])
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert got == sorted(want, key=repr)


def test_decontamination_goes_by_id_and_text(spark):
    rng = random.Random(2)
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    clean = [(None, "clean text without an id"), (None, None), (1, "clean text under a number that is taken"), (2, None), (3, " ".join(words(rng, 50)))]
    bad = [(None, f"before {leak} after"), (1, leak.upper()), (1, leak.upper()), (5, leak)]
    out, got = run(spark, "benchmark_decontamination", clean + bad)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert got == sorted(clean, key=repr)


def test_line_dedup_drops_what_loses_all_lines(spark):
    lines = [f"line number {k} with enough letters" for k in range(6)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines)), (None, "\n".join([*lines[:3], "a line of its own that stays here"])), (None, None), (3, "")]
    out, got = run(spark, "line_dedup", rows)
    left = "a line of its own that stays here"
    assert got == sorted([(1, rows[0][1]), (None, left), (None, None), (3, "")], key=repr)
    assert {r.n_chars for r in out.where("text LIKE 'a line%'").collect()} == {len(left)}
    assert line_dedup.SEED_CHARS <= min(map(len, lines))


def test_toxicity_and_tokens_take_every_document(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = STAGE["toxicity"](spark, docs, SF)
    want = toxicity.op10_toxicity(docs, labels).where("predicted = 0").select("doc_id")
    assert kept.columns == docs.columns and sorted(kept.select("doc_id").collect()) == sorted(want.collect())
    _, got = run(spark, "sentencepiece", [(1, "some text"), (1, "some text"), (None, "é 🙂"), (2, None), (3, "")])
    assert len(got) == 5 and all((r.ids, r.n_tokens) == (None, None) if r.doc_id == 2 else r.round_trip and len(r.ids) == r.n_tokens for r in got)


CLASHES = "__id string, __key string, __copy string, __mask string, __all string, __left string, __lines int, __lost int, __score string, row int, id string, every string, marked int, left int, lines int, lost int, copy int, mask int"


def test_stages_leave_columns_of_any_name_alone(spark):
    extra = [c.split(" ")[0] for c in CLASHES.split(", ")]
    values = [7 if c.endswith(" int") else "v" for c in CLASHES.split(", ")]
    rng = random.Random(4)
    lines = [f"a line of some length, number {k}" for k in range(8)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines, "one more line that is new here"])), (3, None), (None, ""), (5, " ".join(words(rng, 80)))]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t or ""), *values) for i, t in rows], f"{SCHEMA}, {CLASHES}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) >= 4, name
        assert all(tuple(r[c] for c in extra) == tuple(values) for r in got), name


def test_whole_pipeline_from_end_to_end(spark, tmp_path):
    """Planted documents: a toxic one, a copy, a near copy, a leak and a repeated block go; the rest comes out, encoded."""
    source = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(6)
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    near = words(rng, 150)
    block = [f"a repeated line of this block, number {k} of it" for k in range(9)]
    own = {k: [f"line {k} that only document {n} has, with words" for k in range(3)] for n, k in ((1, "a"), (2, "b"))}
    planted = [
        (10_000_001, " ".join(near)),
        (10_000_002, " ".join([*near[:-1], "changed"])),
        (10_000_003, " ".join(near)),
        (10_000_004, f"{' '.join(words(rng, 30))} {leak}"),
        (10_000_005, "\n".join([*own["a"], *block])),
        (10_000_006, "\n".join([*block, *own["b"]])),
        (10_000_007, None),
        (None, ""),
    ]
    rows = spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in planted], SCHEMA)
    source.unionByName(rows).write.parquet(f"{tmp_path}/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = {r.doc_id: r for r in out.collect()}
    assert {10_000_001, 10_000_005, 10_000_006, 10_000_007, None} <= set(got)
    assert not {10_000_002, 10_000_003, 10_000_004} & set(got)
    assert got[10_000_007].ids is None and got[None].n_tokens == 0
    assert all(r.round_trip for r in got.values() if r.ids is not None)
    text = sentencepiece_codec.decode(out.where("doc_id = 10000006")).first().text
    assert text == "\n".join(own["b"])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.op10_toxicity(source, labels).where("predicted = 1").collect()}
    assert toxic and not toxic & set(got)
    assert 0.5 * source.count() < len(got) < source.count() + len(planted)


def test_an_empty_table_goes_through_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
