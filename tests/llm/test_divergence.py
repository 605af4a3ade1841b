import re
from collections import Counter, defaultdict

import pytest

from sparkwharf.llm import divergence as m

FOLD = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    count, docs, sources, out = defaultdict(Counter), defaultdict(Counter), defaultdict(set), []
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(FOLD))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
        sources[lang].add(source)
    for lang, own in sources.items():
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        def shares(c):  # noqa: E306
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        p, q = {s: shares(count[lang, s]) for s in own}, shares(sum((count[lang, s] for s in own), Counter()))
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1)]
    return sorted(out)


def rows():
    hot = [("The cat sat, the CAT ran; éclair naïve x1y", "en", "hot")] * 40
    more = [(f"the dog {'word' * (i % 3)} cat éclair Été {'ran ' * (i % 5)}", "en", f"s{i % 4}") for i in range(40)]
    odd = [(None, None, None), ("", "en", "bare"), ("123 !!", "de", "a"), ("nur einmal", "de", "b"), ("ein", "fr", None), ("Ünï", None, "z")] * 2
    return hot + more + odd + [("the " * 50_000 + "cat", "en", "long")]


@pytest.mark.parametrize("flush", [3, 1 << 19])
@pytest.mark.parametrize("most", [0, 1 << 17])
def test_against_brute_force(spark, monkeypatch, flush, most):
    monkeypatch.setattr(m, "FLUSH", flush)
    monkeypatch.setattr(m, "MAX_SOURCES", most)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows()], "text string, lang string, source string, counts int, p int").repartition(3)
    got = m.divergence(df, min_docs=2, top=3).collect()
    assert sorted(map(tuple, got)) == brute(rows(), 2, 3)


def test_without_documents(spark):
    assert m.divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_shares_are_exact_past_64_bits(spark):
    n = 9_300_000_000
    got = spark.range(1).selectExpr(f"{m.share(f'{n}L', f'{n + 7}L')} AS p").first()["p"]
    assert got == 1 + 10**9 * (n + 5) // (n + 7)


def test_query_over_a_folder(spark, tmp_path):
    spark.createDataFrame(rows(), "text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = m.op11_source_divergence(spark, str(tmp_path))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and sorted(map(tuple, got.collect())) == brute(rows(), 30, 50)
