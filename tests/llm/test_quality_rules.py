import random
import re

from vigia.llm import quality_rules as q


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {p for i, w in enumerate(wins) if wins.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def corpus():
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("a b c d e \n | #x é🙂 the".split(" ")) for _ in range(rng.randint(0, 90))), "x") for i in range(80)]
    rows += [(None, None, "x"), (1, "", None), (2, "\x0b\x0c \t\r\n", "x"), (2, "\x0b\x0c \t\r\n", "x"), (3, "a b c " * 4000, "x"), (4, "   \x85 \x1c z", "x"), (5, "l1 a\nl1 a\n\nl1 a", "x")]
    rows += [(6, " ".join(f"w{i}" for i in range(60)), "x")]
    return rows


def test_measures_match_brute_force(spark):
    rows = corpus()
    got = q.op9_quality_ledger(spark.createDataFrame(rows, "doc_id long, text string, words string").repartition(3)).collect()
    want = [(i, *(brute(t) if len(t or "") < 9000 else (12000, 12000, 0, 0, 12000))) for i, t, _ in rows]
    assert sorted(map(repr, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got))) == sorted(map(repr, want))
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert [r.kept for r in got if r.doc_id == 6 and r.n_words == 60] == [True]


def test_policies_and_ablation_are_bitwise_work_on_the_ledger(spark):
    ledger = q.ledger(spark.createDataFrame(corpus(), "doc_id long, text string, x string")).cache()
    rows = ledger.collect()
    for policy, rules in q.POLICIES.items():
        own = q.mask(rules)
        assert ledger.where(q.fails(policy)).count() == sum(bool(r.failed_bits & own) for r in rows)
        got = {r.rule: (r.failing, r.only_this) for r in q.ablation(ledger, policy).collect()}
        for rule in rules:
            bit = q.mask([rule])
            assert got[rule] == (sum(bool(r.failed_bits & bit) for r in rows), sum(r.failed_bits & own == bit for r in rows))


def test_empty_table_and_no_python(spark):
    out = q.op9_quality_ledger(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()
