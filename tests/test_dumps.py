import pytest
from aircascade.operators import checks, ragged
from aircascade.plans import datasets
from aircascade.schema import EVENT, RAW_EVENT
from aircascade.sources import dumps, files, tables
from aircascade.streaming.ingest import ingest
from pyspark.sql import functions as F

from .dump_fixture import catalogue, event, hit, plain_events, text_of, waveform


def write(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    return str(tmp_path)


def detectors(spark):
    return spark.createDataFrame(catalogue(), "xxyy int, x_cm double, y_cm double, z_cm double")


def one(**kw):
    return {"event": event(), "hits": [hit(505)], "waveforms": [waveform(505)], "bad": []} | kw


def test_tables_hold_what_was_written(spark, tmp_path):
    events = plain_events(5)
    events[-1]["bad"] = []  # its line is blank and stripped
    d = dumps.read_dumps(spark, write(tmp_path, DAT000105_a=text_of(events)))
    assert d.quarantine.count() == 0
    for i, r in enumerate(d.events.orderBy("event_idx").collect()):
        assert [r[name] for name in RAW_EVENT] == pytest.approx(events[i]["event"])
    hits = [tuple(r)[1:] for r in d.hits.orderBy("event_idx", "hit_idx").collect()]
    assert hits == [(i, k, *h) for i, e in enumerate(events) for k, h in enumerate(e["hits"])]
    waves = [(r.event_idx, r.wf_idx, r.xxyy, r.clkcnt, r.mclkcnt, *r.fadc_low, *r.fadc_up) for r in d.waveforms.orderBy("event_idx", "wf_idx").collect()]
    assert waves == [(i, k, *w) for i, e in enumerate(events) for k, w in enumerate(e["waveforms"])]
    assert sorted((r.event_idx, r.xxyy, r.bitf) for r in d.bad_detectors.collect()) == sorted((i, *b) for i, e in enumerate(events) for b in e["bad"])


def test_empty_and_disagreeing_files(spark, tmp_path):
    short = text_of(plain_events(4)).split("\n")
    short.remove(next(x for x in short[short.index("# SD meta DATA") + 1 :]))
    odd = text_of([one(hits=[hit(505)[:-1]])])
    path = write(tmp_path, empty="", markers="EVENT DATA\nSD meta DATA\nSD waveform DATA\nbadsdinfo\n", short="\n".join(short), odd=odd, good=text_of([one()]))
    d = dumps.read_dumps(spark, path)
    assert {r.file_name.split("/")[-1] for r in d.quarantine.collect()} == {"short.txt", "odd.txt"}
    assert d.events.count() == 1 and d.hits.count() == 1
    with pytest.raises(ValueError, match="short|odd"):
        dumps.read_dumps(spark, path, strict=True)


def tile_oracle(e, n):
    """Cells (i, j) -> values by plain loops."""
    known, first = {c[0]: c[1:] for c in catalogue()}, {}
    for h in e["hits"]:
        first.setdefault(h[0], h)
    good = [h for h in first.values() if h[1] > 2]
    if not good:
        return None
    loud = max(good, key=lambda h: (h[4] + h[5]) / 2)
    half, bad = (n - 1) // 2, {b[0] for b in e["bad"]}
    x0, y0 = loud[0] // 100 - half, loud[0] % 100 - half
    mid = known.get((x0 + half) * 100 + y0 + half, (0, 0, 0))
    out = {}
    for i in range(n):
        for j in range(n):
            code = (x0 + i) * 100 + y0 + j
            on, ok, h = code in known, code not in bad, next((h for h in good if h[0] == code), None)
            pos = [(known[code][k] * 1e-2 - mid[k] * 1e-2) / (half * 1200) for k in range(2)] + [(known[code][2] * 1e-2 - 1370) / 30] if on else [0, 0, 0]
            w = next((w for w in e["waveforms"] if w[0] == code), None) if h else None
            trace = [(a / h[9] + b / h[10]) / 2 for a, b in zip(w[3:131], w[131:])] if w else [0] * 128
            out[i, j] = (pos, on, ok, on and ok, (h[2] + h[3]) / 2 * 4000 if h and on and ok else 0, (h[4] + h[5]) / 2 if h else 0, h[11] if h else 0, trace)
    return out


@pytest.mark.parametrize("n", [3, 4, 7])
def test_tiles_equal_plain_loops(spark, tmp_path, n):
    tie = [hit(808, p=(3, 3)), hit(909, p=(3, 3)), hit(1212, 4, p=(1, 1))]
    events = plain_events(4) + [
        one(hits=[hit(505, 2), hit(505, 4)], waveforms=[waveform(505)] * 2),  # the first hit is not good
        one(hits=tie, waveforms=[waveform(h[0]) for h in tie], bad=[[808, 1], [809, 3]]),
        one(hits=[hit(114)], waveforms=[waveform(114, 3), waveform(114, 4)]),  # at the border; a surplus waveform
        one(hits=[hit(606)], waveforms=[waveform(606)]),  # beside the hole
    ]
    d = dumps.read_dumps(spark, write(tmp_path, DAT000105_a=text_of(events)))
    got = {r.event_idx: r for r in datasets.tile_dataset(d, detectors(spark), datasets.TileOptions(ntile=n, layers="mean")).collect()}
    for k, e in enumerate(events):
        want = tile_oracle(e, n)
        assert (want is None) == (k not in got)
        for (i, j), (pos, on, ok, state, t, s, fold, trace) in (want or {}).items():
            r = got[k]
            assert r.detector_positions[i][j] == pytest.approx(pos) and r.detector_exists[i][j] == on and r.detector_good[i][j] == ok and r.detector_states[i][j] == state
            assert r.arrival_times[i][j] == pytest.approx(t) and r.total_signals[i][j] == pytest.approx(s) and r.nfold[i][j] == fold
            assert r.time_traces[i][j] == pytest.approx(trace)
    with pytest.raises(ValueError):
        datasets.tile_dataset(d, detectors(spark), datasets.TileOptions(ntile=2))


def test_dense_array_takes_positions_from_hits(spark, tmp_path):
    from aircascade.operators.tiles import DENSE_ARRAY

    # Ids of hits are yyxx, those of waveforms xxyy.
    d = dumps.read_dumps(spark, write(tmp_path, a=text_of([one(hits=[hit(607, p=(9, 9)), hit(608)], waveforms=[waveform(706), waveform(806)])])))
    r = datasets.tile_dataset(d, None, datasets.TileOptions(ntile=3, layout=DENSE_ARRAY, traces=False)).first()
    assert r.detector_positions_id[1][1] == 706 and r.detector_positions_id[2][1] == 806
    assert r.detector_positions_abs[1][1] == pytest.approx([6 * 1200, 7 * 1200, 600]) and sum(map(sum, r.detector_exists)) == 2


def test_ragged_dataset_and_slices(spark, tmp_path):
    a, b = plain_events(5, 2), plain_events(1, 3)
    # A surplus waveform before, between and behind; and an event that can't match.
    a[1]["waveforms"].insert(0, waveform(9999))
    a[1]["waveforms"].insert(2, waveform(9999))
    a[1]["waveforms"].append(waveform(9999))
    a[3]["waveforms"] = a[3]["waveforms"][:-1]
    path = write(tmp_path, a=text_of(a), b=text_of(b), c="")
    d = dumps.read_dumps(spark, path)
    r = datasets.ragged_dataset(d)
    assert [(x.file_name.split("/")[-1], x.event_idx) for x in r.broken.collect()] == [("a.txt", 3)]
    with pytest.raises(ValueError, match="event 3"):
        datasets.ragged_dataset(d, strict=True)
    got = {}
    for t in r.traces.collect():
        got.setdefault((t.file_name.split("/")[-1], t.event_idx, t.hit_idx), {})[t.fold_idx] = (t.time_traces_low, t.time_traces_up)
    want = {}
    for name, events in (("a.txt", a), ("b.txt", b)):
        for i, e in enumerate(events):
            rest = [w for w in e["waveforms"] if w[0] != 9999]
            if (name, i) == ("a.txt", 3):
                continue
            for k, h in enumerate(e["hits"]):
                mine, rest = rest[: h[11]], rest[h[11] :]
                if h[1] > 2:
                    want[name, i, k] = {f: ([x / h[9] for x in w[3:131]], [x / h[10] for x in w[131:]]) for f, w in enumerate(mine)}
    assert got.keys() == want.keys()
    for key, folds in want.items():
        for f, (low, up) in folds.items():
            assert got[key][f][0] == pytest.approx(low, rel=1e-6) and got[key][f][1] == pytest.approx(up, rel=1e-6)
    assert r.hits.count() == len(want) and r.events.count() == 5
    assert checks.wrong_offsets(ragged.offsets(d.events, d.hits)).count() == 0

    n = tables.per_file(d.events)
    numbered = ragged.globally_numbered(d.events.select(*EVENT), n)
    assert [r.gidx for r in ragged.event_slice(numbered, 3, 6).orderBy("gidx").collect()] == [3, 4, 5]
    at = ragged.located(spark.createDataFrame([(0,), (4,), (5,), (6,), (-1,)], "gidx long"), n).collect()
    assert {(r.gidx, r.file_no, r.local_idx) for r in at} == {(0, 0, 0), (4, 0, 4), (5, 1, 0), (6, None, None), (-1, None, None)}


def test_event_columns_and_name_ids(spark, tmp_path):
    d = dumps.read_dumps(spark, write(tmp_path, DAT012345_x=text_of(plain_events(2)), tasdcalibev_p_160501=text_of(plain_events(1)), other=text_of(plain_events(1))))
    from aircascade.plans.projections import EventOptions, event_columns

    rows = dumps.with_name_ids(d.events, spark.createDataFrame([("nowhere", 5)], "dir string, id_data_set long"))
    got = event_columns(rows).orderBy("file_name", "event_idx").collect()
    assert [(r.id_corsika_shower, r.id_energy_bin, r.ta_obs_date, r.id_data_set) for r in got] == [(123, 45, None, None)] * 2 + [(None, None, None, None), (None, None, 160501, None)]
    e = plain_events(1)[0]["event"]
    r = got[0]
    assert r.std_recon_energy == pytest.approx(e[12]) and r.std_recon_shower_core == pytest.approx([1200 * (e[17] - 12.2435), 1200 * (e[19] - 16.4406)])
    assert r.shower_core == pytest.approx([x * 1e-2 for x in e[4:7]]) and r.std_recon_nsd == int(e[9]) and len(r.std_recon_shower_axis_combined) == 3
    few = event_columns(rows, EventOptions(shower_params=False, combined_fit=False, fixed_curvature_fit=False, metres=False))
    assert not [c for c in few.columns if "combined" in c or "fixed" in c or c == "energy"]


def test_depths(spark, tmp_path):
    from aircascade.plans.projections import with_depth

    path = write(tmp_path, **{f"DAT0001{x}_a": text_of([one(event=[14, 10.0, *event()[2:]])]) for x in ("00", "25", "26", "39")})
    (tmp_path / "DAT1_xmax.txt").write_text("# file n zenith xmax\n\n000100 1 60 400\n000100 1 60 9\n000125 1 0 0\n")
    d = dumps.read_dumps(spark, [f"{path}/DAT0001{x}_a.txt" for x in ("00", "25", "26", "39")])
    rows = with_depth(d.events, tables.read_depths(spark, path), tables.energy_index(spark)).collect()
    x = {r.file_name[-12:-6]: r.xmax for r in rows}
    assert x["000100"] == pytest.approx(800 + 54.4, rel=1e-6)  # one decade above its bin of 1 EeV
    assert all(500 < v < 1500 for v in x.values()) and len(set(x.values())) == 4
    again = {r.file_name[-12:-6]: r.xmax for r in with_depth(d.events.repartition(3), tables.read_depths(spark, path), tables.energy_index(spark)).collect()}
    assert x == again


def test_export_compaction_and_narrowing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = write(tmp_path / "in", a=text_of(plain_events(4)))
    n = datasets.export(spark, path, str(tmp_path / "out"))
    assert n["events"] == 4 and n["hits"] > 0
    m = tables.compact(spark, [f"{tmp_path}/out/hits", f"{tmp_path}/out/hits"], str(tmp_path / "merged"), 1, skip=["nfold"])
    assert m == 2 * n["hits"] and "nfold" not in spark.read.parquet(str(tmp_path / "merged")).columns
    t = datasets.export(spark, path, str(tmp_path / "tiles"), detectors(spark), datasets.TileOptions(ntile=3))
    assert t["tiles"] >= 1
    df = spark.createDataFrame([(126, 127, 40000, 1)], "a long, b long, c long, d long")
    assert [t for _, t in tables.narrowed(df).dtypes] == ["tinyint", "smallint", "int", "tinyint"]
    with pytest.raises(ValueError):
        tables.narrowed(df.select((F.col("a") - 500).alias("a")))


def test_ingest_takes_each_file_once(spark, tmp_path):
    for x in ("in", "out"):
        (tmp_path / x).mkdir()
    write(tmp_path / "in", a=text_of(plain_events(3)))
    run = lambda: ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"))
    run()
    run()
    assert spark.read.parquet(str(tmp_path / "out/events")).count() == 3
    write(tmp_path / "in", b=text_of(plain_events(2)))
    run()
    assert spark.read.parquet(str(tmp_path / "out/events")).count() == 5


def test_manifest(spark, tmp_path):
    for d in ("x", "y"):
        (tmp_path / d).mkdir()
        for i in range(5):
            (tmp_path / d / f"f_{i}.txt").write_text("x")
    (tmp_path / "x" / "g.dat").write_text("x")
    m = files.manifest(spark, f"{tmp_path}/x, {tmp_path}/y", "*.txt,*.dat")
    assert m.count() == 11
    parts = [r["count"] for r in files.divided(m, 4).groupBy("part").count().orderBy("part").collect()]
    cuts = [round(11 / 4 * i) for i in range(5)]
    assert parts == [b - a for a, b in zip(cuts, cuts[1:])]
    assert files.sliced(m, 9).count() == 2 and files.not_ingested(m, spark.createDataFrame([("g.dat",)], "file_name string")).count() == 10
    with pytest.raises(Exception):  # noqa: B017
        files.manifest(spark, str(tmp_path / "none")).count()
