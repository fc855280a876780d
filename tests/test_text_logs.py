"""Edge cases: text cleaning, tokenizing, ties at the k-th place, log lines."""

import datetime as dt

from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import weblog as L
from quillspark.operators import wordcount as W
from quillspark.sources.text import document_lines


def test_strip_is_per_line_and_drops_accents(spark):
    df = spark.createDataFrame([(1, "Étion ok\nfoo\tbar!")], "doc_id long, text string")
    got = [r.line for r in document_lines(df).select(T.strip_chars("line").alias("line"))
           .orderBy("line").collect()]
    assert got == ["foobar", "tion ok"]


def test_clean_count_never_joins_lines(spark):
    df = spark.createDataFrame([(1, "ab\ncd"), (2, "AB  x")], "doc_id long, text string")
    got = {r.word: r.n for r in W.wordcount_top(df, 10, clean=True).collect()}
    assert got == {"ab": 2, "cd": 1, "x": 1}


def test_tokens_skip_empty_and_null(spark):
    df = spark.createDataFrame([(1, "  a \t b\f\r\nc  "), (2, ""), (3, None)], "doc_id long, text string")
    got = sorted(r.word for r in W.word_counts(df, T.split_words("text")).collect())
    assert got == ["a", "b", "c"]


def test_vertical_tab_is_not_a_separator(spark):
    df = spark.createDataFrame([(1, "a\x0bb c")], "doc_id long, text string")
    got = sorted(r.word for r in W.word_counts(df, T.split_words("text")).collect())
    assert got == ["a\x0bb", "c"]


def test_topk_tie_at_kth_place_is_broken_by_key(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 2), ("z", 5)], "word string, n long")
    got = [r.word for r in W.topk_by_count(counts, 3).collect()]
    assert got == ["z", "a", "b"]


def test_prefix_filter_after_folding(spark):
    df = spark.createDataFrame([(1, "Hat hat cat HOT")], "doc_id long, text string")
    got = {r.word: r.n for r in W.wordcount_top(df, 10, fold=True, prefix="h").collect()}
    assert got == {"hat": 2, "hot": 1}


GOOD = '1.2.3.4 - bob [01/Jan/2012:00:00:01 -0800] "GET /a?x=1 HTTP/1.1" 200 - "-" "curl"'


def test_parse_fields_size_dash_and_local_day(spark):
    lines = spark.createDataFrame([(GOOD,)], "line string")
    r = L.parse_access_log(lines).first()
    assert (r.host, r.user, r.verb, r.url, r.status, r.size) == ("1.2.3.4", "bob", "GET", "/a?x=1", 200, None)
    assert r.day == dt.date(2012, 1, 1)          # local text, not shifted by the offset
    assert r.ts == dt.datetime(2012, 1, 1, 0, 0, 1)


def test_reject_keeps_junk_empty_and_null(spark):
    lines = spark.createDataFrame([(GOOD,), ("junk",), ("",), (None,),
                                   ('h i u [bad-time] "GET / HTTP/1.0" x y "r" "a"',)], "line string")
    rejected = sorted(("<null>" if r.line is None else r.line) for r in L.reject_access_log(lines).collect())
    assert rejected == ["", "<null>", 'h i u [bad-time] "GET / HTTP/1.0" x y "r" "a"', "junk"]
    assert [p.host for p in L.parse_access_log(lines).collect()] == ["1.2.3.4"]
    odd = L.parse_access_log(spark.createDataFrame(
        [('h i u [01/Jan/2024:10:00:00 +0000] "GET / HTTP/1.0" x y "r" "a"',)], "line string")).first()
    assert odd.day is not None and odd.status is None and odd.size is None


def test_only_junk_gives_empty_reports(spark):
    lines = spark.createDataFrame([("junk 1",), ("junk 2",)], "line string")
    parsed = L.parse_access_log(lines)
    assert L.hits_by_day(parsed).count() == 0
    assert L.top_pages(parsed).count() == 0


def test_hits_by_day_keeps_one_year_and_sorts(spark):
    mk = lambda d: f'h - u [{d}:10:00:00 +0000] "GET /p HTTP/1.1" 200 5 "-" "a"'
    lines = spark.createDataFrame([(mk("02/Jan/2012"),), (mk("01/Jan/2012"),), (mk("01/Jan/2012"),),
                                   (mk("31/Dec/2011"),)], "line string")
    got = [(r.day.isoformat(), r.n) for r in L.hits_by_day(L.parse_access_log(lines), 2012).collect()]
    assert got == [("2012-01-01", 2), ("2012-01-02", 1)]


def test_top_pages_can_strip_query(spark):
    lines = spark.createDataFrame([(GOOD,), (GOOD.replace("?x=1", "?x=2"),)], "line string")
    got = L.top_pages(L.parse_access_log(lines), 5, strip_query=True).collect()
    assert [(r.url, r.n) for r in got] == [("/a", 2)]


def test_glob_and_gzip_scan(spark, tmp_path):
    from quillspark.sources.text import scan_text_glob
    import gzip
    (tmp_path / "access.log.2012-01-01").write_text("a\nb\n")
    with gzip.open(tmp_path / "access.log.2012-01-02.gz", "wt") as f:
        f.write("c\n")
    (tmp_path / "access.log.2012-02-01").write_text("z\n")
    got = scan_text_glob(spark, str(tmp_path / "access.log.2012-01-??*"))
    assert sorted(r.line for r in got.collect()) == ["a", "b", "c"]
    assert got.select(F.countDistinct("file_path")).first()[0] == 2


def test_status_filter_is_optional(spark):
    ok = GOOD.replace('" 200 -', '" 200 7')
    bad = GOOD.replace('" 200 -', '" 404 7')
    parsed = L.parse_access_log(spark.createDataFrame([(ok,), (bad,), (bad,)], "line string"))
    assert [r.n for r in L.hits_by_day(parsed).collect()] == [3]
    assert [r.n for r in L.hits_by_day(parsed, statuses=[200]).collect()] == [1]
    assert [(r.url, r.n) for r in L.top_pages(parsed, 5, statuses=[404]).collect()] == [("/a?x=1", 2)]


def test_rejects_are_the_complement_of_the_report(spark):
    from quillspark.operators import weblog as L
    good = '10.0.0.1 - u [01/Jan/2024:10:00:00 +0000] "GET /a HTTP/1.1" 200 - "r" "a" extra'
    lines = [good, good.replace("Jan", "Foo"), good.replace("01/Jan", "?01/Jan"), "junk", "", None, good + "\nmore"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    parsed, rejected = L.parse_access_log(df).collect(), L.reject_access_log(df).collect()
    assert [r.host for r in parsed] == ["10.0.0.1"] and parsed[0].size is None and parsed[0].agent == "a"
    assert len(parsed) + len(rejected) == len(lines) and good not in [r.line for r in rejected]
