"""URL filter, decontamination, toxicity and the pipeline on small tables."""

import random
import re

import numpy as np

from vigia.llm import decontaminate, toxicity, url_filter


def test_url_rules_match_plain_python(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?q#f", "x://net/", "x://net", "x://subnet/a", "x://a.org/fr/1", "x://a.org/frx", "x://example.com/de/?a", "x://b.example.com/de/z", "x://é.org/fr/", "a://b://c.net/d", "x://h.net?x/y", "x://EXAMPLE.net/en/"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate([*urls, urls[4]])] + [(None, "x://a.net/", "z")], "page_id long, url string, host string")
    for r in url_filter.judged(pages).collect():
        url = "x://a.net/" if r.page_id is None else [*urls, urls[4]][r.page_id]
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda x: len(x[0]), default=(None, None))
        assert (r.host, r.path, r.rule, r.rule_verdict) == (host, path, *best)
    assert url_filter.op2_url_filter(pages).count() == 18
    assert url_filter.op2_url_filter(pages.where("1 = 0")).count() == 0


def test_smith_waterman_matches_the_plain_table():
    rng = random.Random(1)
    for _ in range(50):
        a = [rng.randrange(2, 6) for _ in range(rng.randrange(1, 12))]
        b = [rng.randrange(2, 6) for _ in range(rng.randrange(1, 20))]
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        got, _ = decontaminate.smith_waterman(np.array([a + [0] * 3], np.uint64), np.array([b + [1] * 4], np.uint64))
        assert got[0] == max(map(max, h))


def test_copies_and_edited_copies_are_found(spark):
    rng = random.Random(2)
    fresh = lambda n: [f"t{rng.randrange(5000)}" for _ in range(n)]
    items = [fresh(30) for _ in range(20)]
    docs = [(i, " ".join(fresh(200))) for i in range(60)] + [(None, None), (500, ""), (501, "a b")]
    for i in range(10):
        edited = list(items[i])
        for k in (7, 15, 22):
            edited[k] = "changed"
        del edited[11]
        docs.append((100 + i, " ".join([*fresh(50), *(items[i] if i % 2 else edited), *fresh(50)]).upper()))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(98, None), (99, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, bench).collect()}
    assert got == {(100 + i, i) for i in range(10)}
    assert decontaminate.decontaminate(table, bench).count() == 63
    assert decontaminate.contaminated(table, bench.where("1 = 0")).count() == 0


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.op10_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) > 0.95
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    assert [r.predicted for r in toxicity.op10_toxicity(odd, labels.where("1 = 0")).collect()] == [0, 0, 0]


def plain_smith_waterman(a, b):
    above, best = [0] * (len(b) + 1), 0
    for x in a:
        here = [0]
        for j, y in enumerate(b, 1):
            here.append(max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, here[-1] - 1))
        above, best = here, max(best, *here)
    return best


def test_edited_and_partial_copies_match_the_alignment_of_all_pairs(spark):
    rng = random.Random(5)
    fresh = lambda n: [f"t{rng.randrange(3000)}" for _ in range(n)]
    common = ["one", "of", "the", "most"]
    items = [[*fresh(10), *common, *fresh(n)] for n in (16, 20, 41, 3, 90)] + [[*common, "x"]]
    docs, planted = [" ".join([*fresh(30), *common, *fresh(30)]) for _ in range(40)], set()
    for k, item in enumerate(items[:5]):
        for share in (0.2, 0.25, 0.3, 0.33):
            edited = [f"new{rng.randrange(10**6)}" if rng.random() < share else x for x in item]
            docs.append(" ".join([*fresh(rng.randrange(400)), *edited, *fresh(20)]))
        inserted = [y for x in item for y in ([x] if rng.random() < 0.8 else [x, *fresh(4)])]
        docs += [" ".join([*fresh(20), *inserted]), " ".join([*fresh(9), *item[1:14], *fresh(50)])]
        planted |= {(len(docs) - 1, k)}
        docs.append(" ".join("changed" if i % 4 == 3 else x for i, x in enumerate(item)))
        planted |= {(len(docs) - 1, k)}
    want = set()
    for d, text in enumerate(docs):
        words = text.split()
        for k, item in enumerate(items):
            seeds = {tuple(item[i : i + 3]) for i in range(len(item) - 2)}
            score = plain_smith_waterman(item, words)
            if any(tuple(words[i : i + 3]) in seeds for i in range(len(words) - 2)) and (score >= len(item) or score >= 26):
                want.add((d, k, score))
    assert planted <= {p[:2] for p in want}
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.score) for r in decontaminate.contaminated(table, bench).collect()} == want


def plain_scores(urls, rules, terms):
    """Scores and blocked URLs by id, of (id, url) that no rule fits, by the method's text."""
    from collections import Counter
    from math import log
    from zlib import crc32

    def parts(url):
        host, path, query = re.match(r"([^/?#]*)([^?#]*)(\?[^#]*)?", url.split("://", 1)[1]).groups()
        host = host.lower()
        fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        text = re.sub("[^a-z0./_-]", "*", re.sub("[0-9]", "0", (host + path + (query or "")).lower()))
        return "^^^" + text + "$", max(fits, key=lambda x: len(x[0]), default=(None, None))[1], any(t in host for t in terms)

    every = {i: parts(u) for i, u in urls}
    side = {i: None if rule == "block" else "rejected" if named else "accepted" if rule == "allow" else None for i, (_, rule, named) in every.items()}
    held = {i: crc32(str(i).encode()) % 5 == 0 for i in every}
    counts = {"accepted": Counter(), "rejected": Counter()}
    for i, (s, _, _) in every.items():
        if side[i] and not held[i]:
            for k in range(3, len(s)):
                counts[side[i]].update(s[k - n : k + 1] for n in range(4))

    def p(of, gram):
        below = p(of, gram[1:]) if len(gram) > 1 else 1 / url_filter.ALPHABET
        seen = [n for g, n in counts[of].items() if len(g) == len(gram) and g[:-1] == gram[:-1]]
        return (counts[of][gram] + len(seen) * below) / (sum(seen) + len(seen)) if seen else below

    known = {}
    for s, _, _ in every.values():
        for k in range(3, len(s)):
            g = s[k - 3 : k + 1]
            known.setdefault(g, log(p("accepted", g)) - log(p("rejected", g)))
    score = {i: sum(known[s[k - 3 : k + 1]] for k in range(3, len(s))) / (len(s) - 3) for i, (s, _, _) in every.items()}
    return score, {i for i, (_, rule, _) in every.items() if rule is None}, side, held


def test_whole_urls_are_scored_as_plain_python_does(spark):
    rng = random.Random(8)
    rules = (("allow", "org", "/"), ("block", "net", "/"), ("allow", "co.uk", "/news/"))
    name = lambda: "".join(rng.choice(["ka", "lo", "mi", "ter", "son"]) for _ in range(3))
    urls = [f"https://{name()}.org/{name()}/{k}?id={k}" for k in range(60)] + [f"http://www.{name()}.co.uk/news/{name()}" for _ in range(40)]
    urls += [f"https://{rng.choice(['cheap-pills', 'casino', 'big-bets'])}{rng.choice(['.com', '.net.au', '-win.example.com', '.net'])}/{rng.choice(['', 'win', 'bets/now?bonus=1'])}" for _ in range(80)]
    judged = ["https://cheap-pills.com/", "https://kalomi.com/", "https://casino.net.au/bets/", "https://terson.net.au/kalo/", "https://miter.com/lo?id=7", "https://miter.com/lo?bonus=1", "https://sonka.com#top", "http://pills.net/"]
    rows = list(enumerate(urls + judged))
    score, open_, side, held = plain_scores(rows, rules, url_filter.REJECTED_TERMS)
    got = {r.page_id: r for r in url_filter.op2_url_filter(spark.createDataFrame(rows, "page_id long, url string").repartition(3), rules).collect()}
    assert len(got) == len(rows) and all(abs(got[i].score - score[i]) < 0.0021 for i in score)
    assert side[rows[-1][0]] is None
    by = {u: got[i] for i, u in rows if i >= len(urls)}
    assert by[judged[0]].score < by[judged[1]].score and by[judged[2]].score < by[judged[3]].score and by[judged[5]].score < by[judged[4]].score
    assert (by[judged[0]].verdict, by[judged[1]].verdict, by[judged[2]].verdict) == ("block", "allow", "block")
