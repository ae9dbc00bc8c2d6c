"""Source mixing against its SQL and its promises."""
import duckdb

from tests.llm.fixtures import DDL, awkward_docs, docs_frame, tokens, with_clashing_columns
from tramline.llm import mixing


def sql_rows(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    return con.execute(mixing.ORACLE_SQL).fetchall()


def test_same_as_sql_on_awkward_documents(spark):
    got = mixing.mix(with_clashing_columns(docs_frame(spark))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, sql_rows(awkward_docs())))


def test_targets_share_everything_and_respect_the_cap(spark):
    rows = [(k, "w " * (k % 40), "en", f"s{k % 7}" if k % 5 else "big", 0) for k in range(4000)]
    got = mixing.mix(docs_frame(spark, rows)).collect()
    source = {r[0]: r[3] for r in rows}
    target, own, taken = {}, {}, {}
    for r in got:
        s = source[r.doc_id]
        target[s], own[s] = r.target, r.source_size
        taken[s] = taken.get(s, 0) + r.taken
        assert r.size == len(tokens(rows[r.doc_id][1])) and r.taken <= 3 * r.size
    assert abs(sum(target.values()) - sum(own.values())) < 1e-6 * sum(own.values())
    assert all(target[s] <= 3 * own[s] + 1e-6 for s in target)
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 80 for s in target)
    free = [s for s in target if target[s] < 3 * own[s] - 1e-6]
    weight = dict(zip(sorted(target), [5, 2, 1] * 3))
    assert len({round(target[s] / weight[s], 3) for s in free}) == 1


def test_mixed_repeats_whole_rows(spark):
    docs = with_clashing_columns(docs_frame(spark))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    times = {}
    for r in out.collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    copies = {}
    for r in mixing.copies(docs_frame(spark)).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    assert times == {k: v for k, v in copies.items() if v}


def test_reruns_agree_however_rows_are_dealt(spark):
    docs = docs_frame(spark)
    a, b = (sorted(map(str, mixing.mix(docs.repartition(n)).collect())) for n in (1, 7))
    assert a == b


def test_empty_table_and_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], DDL)).count() == 0
    got = mixing.mix(docs_frame(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2
