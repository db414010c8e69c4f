import hashlib
import random
import re

from vigia.llm import secret_scan

KEY = "AKIA" + "ABCDEFGH12345678"


def brute(text):
    found = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "", re.ASCII):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


def corpus():
    rng = random.Random(3)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = ["connection", "understanding", "read_parquet_file", "read_file", "file_path_of", "straße", "implementation_detail", "of", "the", "organizational"]
    secret = lambda n: "".join(rng.choice(chars) for _ in range(n))
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words) for _ in range(60))
        if i % 10 == 0:
            text += f" api_key = '{secret(32)}' é"
        rows.append((i, text, "x"))
    rows += [
        (1000, f"é🙂 see {secret(40)} there", "x"), (1001, None, None), (1002, "", "x"), (None, f"PASSWORD:{secret(12)}", "x"),
        (1003, f"k {KEY} and {KEY[:15]} " + "0f" * 20 + " password=api_key: abcdefgh token=short", "x"), (1003, "internationalization_of_the_implementation", "x"),
        (1004, "deadbeef" * 4 + " ſecret=abcdefghij " + "a" * 200_000, "x"),
    ]
    return rows


def test_base_spans_match_brute_force(spark):
    rows = corpus()
    got = secret_scan.op8_secret_scan(spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), hashlib.sha256(",".join(brute(t)).encode()).hexdigest()) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    by = {(r.doc_id, r.base_sha256): r for r in got}
    for i, text, _ in rows:
        base = brute(text)
        r = by[(i, hashlib.sha256(",".join(base).encode()).hexdigest())]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex"))
        assert [s for s in r.spans.split(",") if s and not s.startswith("markov")] == base


def test_markov_finds_random_tokens_and_leaves_identifiers(spark):
    rows = corpus()
    got = secret_scan.op8_secret_scan(spark.createDataFrame(rows, "doc_id long, text string, x string")).where("n_markov > 0").collect()
    by = {r.doc_id: r for r in got}
    assert 1000 in by and not [i for i in by if i is None or i < 300]
    assert not any("internationalization" in rows[[x[0] for x in rows].index(r.doc_id)][1] for r in got)
    a, b = map(int, by[1000].spans.split(":")[1:])
    assert re.fullmatch("[A-Za-z0-9]{40}", rows[300][1][a:b])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "plain words alone understanding"), (2, None)], "doc_id long, text string")
    assert [r.spans for r in secret_scan.op8_secret_scan(docs).collect()] == ["", ""]
    assert secret_scan.op8_secret_scan(docs.where("1 = 0")).count() == 0


def test_long_dated_identifiers_are_clean_at_two_corpus_sizes(spark):
    rng = random.Random(9)
    dated = ["2024-10-17_report", "release-notes-2024", "articles/2024/october/report", "invoice-20241017-0001", "1234567890123456", "2024-10-17T12-30-00", "section-1-2-3-figure-14"]
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    hidden = ["".join(rng.choice(chars) for _ in range(n)) for n in (24, 32, 40)] + ["".join(rng.choice("0123456789abcdef") for _ in range(24))]
    rows = [(k, f"see {x} there") for k, x in enumerate([*dated, *hidden])]
    for size in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text").where("doc_id > 100")
        table = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
        got = {r.doc_id: r.n_markov for r in secret_scan.op8_secret_scan(table).where("doc_id < 100").collect()}
        assert [x for k, x in enumerate(dated) if got[k]] == []
        assert [x for k, x in enumerate(hidden, len(dated)) if not got[k]] == []
