from pyspark.sql import functions as F

from millrace.llm import licence_texts, licences, mixing, sharding


def test_licences_match_across_spellings(llm):
    mit = licence_texts.LICENCES[-1][1]
    other = "Copyright (c) 2020 Someone\n© 2021 Another\n" + mit.upper().replace("LICENSE", "LICENCE").replace(" ", "  ").replace('"', "“").replace("\n", "\r\n")
    rows = [(1, mit), (1, mit), (2, other), (3, None), (4, ""), (5, "..."), (6, mit + "and more"), (7, "x " * 200_000), (None, mit.replace("copy,", "clone,"))]
    frame = llm.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS license_id", "1 AS form")
    got = sorted(((r.doc_id or 0, r.license_id) for r in licences.scan(frame, licences.known_licences(llm)).collect()), key=repr)
    assert got == sorted([(1, "MIT"), (1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (6, None), (7, None), (0, None)], key=repr)
    empty = llm.createDataFrame([("none", "...")], "license_id string, text string")
    assert licences.scan(frame, empty).where("license_id IS NOT NULL").count() == 0
    assert licences.scan(frame.limit(0), licences.known_licences(llm)).count() == 0


def test_notices_of_lines(llm):
    texts = ["a\nReleased under the MIT licence!\r\nLicensed under CC BY-NC 4.0.", "Not released under the MIT License.", None, ""]
    frame = llm.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in frame.select(licences.notices(F.col("text"))).collect()] == ["CC-BY-NC-4.0,MIT", "", "", ""]


def test_lookup_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(10)]
    full = sharding.fill(names, 1009)
    counts = [full.count(i) for i in range(10)]
    assert max(counts) - min(counts) <= 1 and -1 not in full
    fewer = sharding.fill(names[:9], 1009)
    kept = sum(a == b for a, b in zip(full, fewer, strict=True) if a != 9)
    assert kept >= 0.8 * sum(a != 9 for a in full)
    assert sharding.fill(["only"], 2) == [0, 0]


def test_placement_of_odd_keys(llm):
    frame = llm.createDataFrame([("a",), ("a",), (None,), ("",), ("b" * 100_000,)], "doc_id string").selectExpr("*", "1 AS slot", "2 AS owner")
    got = sharding.place(frame, "doc_id", ["x", "y"], 11).collect()
    assert len(got) == 5 and len({(r.slot, r.shard) for r in got if r.doc_id == "a"}) == 1
    assert len({r.slot for r in got if not r.doc_id}) == 1
    assert sharding.place(frame.limit(0), "doc_id", ["x"], 11).count() == 0


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in order}
        capped |= over


def test_targets_and_copies(llm):
    words = {"a": 9000, "b": 10, "c": 1, "B": 0, None: 500, "é": 30, "z": 2000}
    rows = []
    for source, n in words.items():
        rows += [(len(rows) + i, "w " * 10, source) for i in range(n // 10)] + [(None, "w\t" * (n % 10), source)]
    rows += [(1_000_000, None, "a"), (1_000_001, "", "B")]
    frame = llm.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS rate", "3 AS weight")
    mixed = mixing.mix(frame).cache()
    want = brute_targets(words)
    got = mixed.groupBy("source").agg(F.first("target").alias("t"), F.first("source_size").alias("n"), F.sum(F.col("size") * F.col("copies")).alias("taken"), F.count("*").alias("rows")).collect()
    assert {r.source: r.n for r in got} == words and sum(r.rows for r in got) == len(rows)
    for r in got:
        assert abs(r.t - want[r.source]) <= 1e-9 * max(1, r.t)
        assert abs((r.taken or 0) - r.t) <= 0.1 * r.t + 60
    assert mixed.where("copies > 3 OR copies < 0").count() == 0
    assert sorted(map(str, mixing.mix(frame).collect())) == sorted(map(str, mixed.collect()))
    assert mixing.repeated(mixed).count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixing.mix(frame.limit(0)).count() == 0


def test_names_of_the_operators_own_columns(llm):
    own = ["_of", "_of0", "_copy", "_copy0", "OF", "weight", "level", "form", "_bare0", "_other0"]
    frame = llm.createDataFrame([(i, "w w", f"s{i % 3}") for i in range(30)], "doc_id long, text string, source string")
    clashing = frame.select("*", *[F.lit(i).alias(n) for i, n in enumerate(own)])
    mixed = mixing.mix(clashing)
    kept = [c for c in clashing.columns if c != "weight"]
    assert mixed.select(kept).columns == kept
    assert mixing.repeated(mixed).columns == kept
    assert mixing.repeated(mixed).count() == mixing.repeated(mixing.mix(frame)).count()
    assert set(licences.scan(clashing, licences.known_licences(llm)).columns) == {*clashing.columns, "digest", "license_id"}


def test_many_sources_are_joined_not_broadcast(llm, monkeypatch):
    rows = [(i, "w w", f"s{i % 7}") for i in range(50)]
    frame = llm.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(map(str, mixing.mix(frame).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted(map(str, mixing.mix(frame).collect())) == want
