"""Quality rules, mixing and url filters: DuckDB parity and edge cases."""

import math

import duckdb
import pytest

from quillspark.llm import mixing, oracles, quality, urlfilter
from quillspark.llm.queries import URL_RULES, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(oracles.oracle_sql()))
def test_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(oracles.oracle_sql()[key])
    names = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    assert sorted(repr(tuple(r[n] for n in names)) for r in queries()[key](spark, SF).collect()) == want


def slow_repeats(text):
    w = (text or "").split()
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    return len({i + k for p in seen.values() if len(p) > 1 for i in p for k in range(5)})


def test_quality_edges(docs_of):
    rows = [(1, None), (1, None), (2, ""), (None, "a b c d e f"), (3, "x y z " * 9), (4, "the cat\nthe cat\n\n \nsat")]
    got = {r.doc_id: r for r in quality.judge_quality(docs_of(rows)).collect()}
    assert (got[1].n_words, got[1].base_failed, got[1].kept) == (0, True, False)
    assert got[3].n_repeat_words == slow_repeats(rows[4][1]) and got[3].base_failed
    assert got[4].n_dup_lines == 1
    assert quality.judge_quality(docs_of(rows).filter("false")).count() == 0


def test_quality_projection_has_no_user_function(spark):
    plan = queries()["op7_quality"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange hash"))


def test_mixing_is_native_and_edges(docs_of):
    rows = [(1, "aaaa", "s"), (1, "aaaa", "s"), (None, "bbbb", None), (2, None, "t"), (3, "", "t"), (4, "c" * 40, "u")]
    out = mixing.mix_sources(docs_of(rows), {"u": 0.0}, epochs=30.0)
    got = out.collect()
    assert {r.source for r in got} == {"s", None}
    assert "cell" in out.columns and out.schema["copy"].dataType.simpleString() == "int"
    assert len({r.shuffle_key for r in got}) == len(got)  # equal rows draw and are dealt apart
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
    assert mixing.mix_sources(docs_of(rows).filter("false")).count() == 0


@pytest.mark.parametrize("cells", [10**6, 0])
def test_mixing_reaches_its_rates(spark, cells, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_BROADCAST_CELLS", cells)
    df = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', 10) AS text", "'en' AS lang",
                                      "IF(id % 4 = 0, 'a', 'b') AS source", "10L AS n_chars")
    n = {r.source: r["count"] for r in mixing.mix_sources(df, {"a": 3.0}, 1.0).groupBy("source").count().collect()}
    assert abs(n["a"] - 3000) < 5 * math.sqrt(3000) and abs(n["b"] - 1000) < 5 * math.sqrt(1000)


@pytest.mark.parametrize("rows", [
    [(None, f"text {i}", "s") for i in range(2000)], [(None, "same", "s")] * 2000, [(7, "same", "s")] * 2000,
    [(7, f"text {i % 50}", "s") for i in range(2000)]])
@pytest.mark.parametrize("cells", [10**6, 0])
def test_rows_without_an_id_of_their_own_draw_apart(docs_of, monkeypatch, rows, cells):
    """At rate 1 the mean of 2,000 independent draws lies within 5 deviations, and so does the
    share of rows that are left out."""
    monkeypatch.setattr(mixing, "MAX_BROADCAST_CELLS", cells)
    got = mixing.mix_sources(docs_of(rows, 4)).collect()
    assert abs(len(got) - 2000) < 5 * math.sqrt(2000)
    drawn = sum(r.copy == 0 for r in got)
    assert abs(drawn - 2000 * (1 - math.exp(-1))) < 5 * math.sqrt(2000 * 0.25)


URLS = [None, "", "nohost", "http://", "HTTP://A.Example.ORG/en/12?x#y", "https://example.org/es/", "http://example.org",
        "http://x.com/fr/1", "http://com/de/", "http://dotcom/de/", "http://a.com?/de/", "http://a.com/de", "x://b.org#/",
        "http://my-example.org/es/", "http://deep.a.b.example.org/es/x", "ftp://é.org/ü?q"]


def slow_verdict(url):
    host, path = urlfilter.split_url(url)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")


def test_url_paths_agree(spark):
    df = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(URLS)], "page_id long, url string, html string, host string")
    want = {i: slow_verdict(u) for i, u in enumerate(URLS)}
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, prefix string")
    for out in (urlfilter.judge_urls(df, URL_RULES), urlfilter.judge_urls_by_join(df, rules)):
        assert {r.page_id: tuple(r)[1:] for r in out.collect()} == want
    assert urlfilter.judge_urls(df, [], "block").filter("verdict = 'block'").count() == len(URLS)
    assert urlfilter.judge_urls(df.filter("false"), URL_RULES).count() == 0


def test_digest_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urlfilter.xxhash, "xxh64_intdigest", lambda b, *_: 5)
    path = str(tmp_path / "rules")
    urlfilter.DigestArray.write([("block", "a.com", "/x"), ("allow", "b.com", "")], path)
    a = urlfilter.DigestArray(path)
    i, j, k = a.lookup(["a.com/x", "b.com", "c.com"])
    assert k == -1 and i != j and {a.verdicts[i], a.verdicts[j]} == {0, 1}


def test_join_on_the_table_takes_the_last_rule_of_a_key(spark):
    from quillspark.sources.tables import table
    again = [*URL_RULES, *((("allow" if v == "block" else "block"), h, p) for v, h, p in URL_RULES[:2])]
    again = [(("allow" if again[2][0] == "block" else "block"), *again[2][1:]), *again]
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    rules = spark.createDataFrame(again, "verdict string, host string, prefix string")
    want = sorted(tuple(r) for r in urlfilter.judge_urls(pages, again).fillna("-").collect())
    assert sorted(tuple(r) for r in urlfilter.judge_urls_by_join(pages, rules).fillna("-").collect()) == want
