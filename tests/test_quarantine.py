"""Landed lines that cannot be staged are kept with the reason, in batch and stream; every line is in one table."""

import datetime as dt


from conftest import BASE, SF0001
from dimforge.operators.scd2 import merge_changes, snapshot_merge
from dimforge.plans.staging import staged_and_quarantined
from dimforge.plans.warehouse import GEO_CHECK, GEO_KEY, build_run
from dimforge.sources.fixture import crimes_raw
from dimforge.sources.history import HistoryStore
from dimforge.sources.landing import LANDING_COLUMNS, read_landing_checked, write_landing
from dimforge.streaming.incremental import stream_snapshots, stream_staging


def csv(**fields):
    return ",".join(str({**BASE, **fields}.get(c, "")) for c in LANDING_COLUMNS)


BAD = {
    "short": ("77,HX77,01/15/2010 10:30:00 AM", "not in the landing layout"),
    "long": (csv(id="78") + ",one,two", "not in the landing layout"),
    "open quote": (csv(id="79", block='"001XX, BLOCK'), "not in the landing layout"),
    "no id": (csv(id=""), "no id"),
    "no date": (csv(id="80", date=""), "no date"),
    "bad id": (csv(id="8x1"), "id is no number"),
    "bad date": (csv(id="82", date="2010-01-15"), "date is no timestamp"),
}
GOOD = [csv(id=str(i)) for i in range(1, 6)] + [csv(id="6", block='"001XX, BLOCK ""A"""'), csv(id="7", latitude="north")]


def write(folder, lines):
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text("\n".join([",".join(LANDING_COLUMNS), *lines]) + "\n")


def test_every_line_is_staged_or_quarantined(spark, tmp_path):
    write(tmp_path / "landing", [*GOOD, *(x for x, _ in BAD.values())])
    raw = read_landing_checked(spark, str(tmp_path / "landing"))
    staged, bad = staged_and_quarantined(raw)
    assert sorted(r[0] for r in staged.select("id_ocorrencia").collect()) == [*range(1, 8)]
    got = [(r.reason, r.line) for r in bad.collect()]
    assert sorted(r for r, _ in got) == sorted(r for _, r in BAD.values())
    assert len(got) + staged.count() == len(GOOD) + len(BAD)
    lines = " ".join(line for _, line in got)
    assert BAD["short"][0] in lines and BAD["long"][0] in lines and '"id":"8x1"' in lines


def test_build_writes_the_quarantine(spark, tmp_path):
    write(tmp_path / "landing", [*GOOD, *(x for x, _ in BAD.values())])
    w = build_run(spark, read_landing_checked(spark, str(tmp_path / "landing")), str(tmp_path / "wh"), dt.datetime(2012, 1, 1), lenient=True)
    assert w.fct_ocorrencias.count() == len(GOOD)
    assert spark.read.parquet(str(tmp_path / "wh/quarantine/as_of=20120101000000")).count() == len(BAD)
    assert "fct_ocorrencias" in w.create_views()
    assert spark.sql("SELECT count(*) AS n FROM fct_ocorrencias JOIN dim_crime USING (sk_crime)").first().n == len(GOOD)


def test_stream_keeps_all_lines(spark, tmp_path):
    args = (str(tmp_path / "landing/*"), str(tmp_path / "staged"), str(tmp_path / "ckpt"))
    write(tmp_path / "landing/a", [*GOOD, *(x for x, _ in BAD.values())])
    stream_staging(spark, *args, lenient=True).awaitTermination()
    write(tmp_path / "landing/b", [csv(id="100"), BAD["long"][0]])
    stream_staging(spark, *args, lenient=True).awaitTermination()
    assert spark.read.parquet(args[1]).count() == len(GOOD) + 1
    bad = spark.read.parquet(args[1] + "_quarantine")
    assert bad.count() == len(BAD) + 1 and bad.where("line LIKE '%one,two'").count() == 2


def test_checked_landing_of_clean_files_loses_nothing(spark, tmp_path):
    raw = crimes_raw(spark, SF0001)
    write_landing(raw, str(tmp_path / "l"))
    staged, bad = staged_and_quarantined(read_landing_checked(spark, str(tmp_path / "l")))
    assert bad.count() == 0 and staged.count() == raw.count()


T = [dt.datetime(2011, 1, k) for k in range(1, 6)]


def test_changed_keys_merge_as_the_full_state_does(spark):
    import random

    r = random.Random(2)
    state = {k: r.randrange(4) for k in range(40)}
    frame = lambda s: spark.createDataFrame([*s.items()], "beat int, district int")
    full = part = None
    before: dict = {}
    for t in T:
        changes = [(k, state.get(k), k not in state) for k in {*before, *state} if before.get(k, -1) != state.get(k, -1) or r.random() < 0.1]
        full = snapshot_merge(frame(state), GEO_KEY, GEO_CHECK, t, full)
        part = merge_changes(spark.createDataFrame(changes, "beat int, district int, _gone boolean"), GEO_KEY, GEO_CHECK, t, part)
        before = dict(state)
        for k in r.sample(range(45), 6):
            if k in state and r.random() < 0.4:
                del state[k]
            else:
                state[k] = r.choice([None, 1, 2, 3])
    rows = lambda df: sorted(map(str, df.select("beat", "district", "dbt_valid_from", "dbt_valid_to").collect()))
    assert rows(part) == rows(full)


def test_stream_merges_touched_keys_and_explicit_deletes(spark, tmp_path):
    rows = "beat int, district int, t timestamp_ntz, id long, removed boolean"
    staged, store, merged = str(tmp_path / "staged"), HistoryStore(spark, str(tmp_path / "h")), []
    import dimforge.streaming.incremental as inc

    def spy(changes, *a, **kw):
        merged.append(changes.count())
        return merge_changes(changes, *a, **kw)

    kept, inc.merge_changes = inc.merge_changes, spy
    try:
        def run(data, as_of):
            spark.createDataFrame(data, rows).coalesce(1).write.mode("append").parquet(staged)
            src = spark.readStream.schema(rows).parquet(staged)
            stream_snapshots(src, store, GEO_KEY, GEO_CHECK, "t", "id", str(tmp_path / "ckpt"), clock=lambda: as_of, deleted="removed").awaitTermination()

        run([(k, 1, T[0], k, False) for k in range(50)], T[0])
        run([(3, 2, T[1], 100, False), (4, 1, T[1], 101, True)], T[1])
        run([(4, 1, T[2], 102, False), (5, 9, dt.datetime(2000, 1, 1), 103, False)], T[2])  # 5: an old row changes nothing
    finally:
        inc.merge_changes = kept
    assert merged == [50, 2, 2]
    got = {(r.beat, r.district, r.dbt_valid_from, r.dbt_valid_to) for r in store.latest().where("beat IN (3, 4, 5)").collect()}
    assert got == {(3, 1, T[0], T[1]), (3, 2, T[1], None), (4, 1, T[0], T[1]), (4, 1, T[2], None), (5, 1, T[0], None)}
    assert store.latest().count() == 52
