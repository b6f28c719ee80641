from fractions import Fraction

import pytest
from edge import frame, repeated
from hypothesis import given, settings
from hypothesis import strategies as st

from dimforge.llm import mixing


def simulate(share, slots):
    """Earliest deadline first over released blocks, by the definition; ties by the order of the sources."""
    period, done, out = sum(share.values()), {s: 0 for s in share}, []
    for t in range(slots):
        ready = [(-(-(done[s] + 1) * period // share[s]), k, s) for k, s in enumerate(share) if done[s] * period // share[s] <= t]
        _, _, s = min(ready)
        out.append((s, done[s]))
        done[s] += 1
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 50), st.integers(1, 40), min_size=1, max_size=12))
def test_schedule_is_earliest_deadline_first_and_stays_within_one_block(share):
    period = sum(share.values())
    laid = [*mixing.edf([*share.values()], [*share.values()])]
    names = [*share]
    assert [(names[k], j) for k, j, _, _, _ in laid] == simulate(share, period)
    count = dict.fromkeys(share, 0)
    for t, (k, j, release, due, slot) in enumerate(laid):
        s = names[k]
        assert slot == t and release == j * period // share[s] <= t < due == -(-(j + 1) * period // share[s])
        count[s] += 1
        assert all(abs(count[x] - share[x] * (t + 1) / period) < 1 for x in share)


def test_rows_are_placed_by_the_schedule(spark):
    data = [(i, "t", "en", f"src{0 if i % 3 else i % 7}", 1) for i in range(400)] + [(1000 + i, "t", "en", None, 1) for i in range(30)] + [(2000, "t", "en", "other", 1)]
    weights = {"src0": 4.0, "src1": 1.0, "src2": 1.0, "src3": 1.0, None: 1.0}
    got = mixing.mix(frame(spark, data), weights, 2.0, block_rows=4, blocks=4).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in data) and len({r.position for r in got}) == len(data)
    named = list(weights)
    group = lambda s: named.index(s) if s in named else len(named)
    rows = [sum(group(d[3]) == k for d in data) for k in range(len(named) + 1)]
    order = {(k, j): slot for k, j, _, _, slot in mixing.edf(mixing.whole([*weights.values(), 2.0]), [-(-n // 4) for n in rows])}
    for r in got:
        assert r.slot == order[group(r.source), r.block] and r.release <= r.slot < r.deadline and r.position // 4 == r.slot
    for k in range(len(rows)):  # gapless ranks in each group
        places = sorted(r.block * 4 + r.position % 4 for r in got if group(r.source) == k)
        assert places == list(range(len(places)))


def test_schedules_stay_small_whatever_the_rows(spark, monkeypatch):
    laid = []
    monkeypatch.setattr(mixing, "ENTRIES", 50)
    monkeypatch.setattr(mixing, "scheduled", lambda spark, share, many, at=mixing.scheduled: (laid.append(sum(many)), at(spark, share, many))[1])
    docs = frame(spark, [(i, "t", "en", "hot" if i % 3 == 0 else f"s{i % 4}", 1) for i in range(6000)])
    weights, rest = mixing.tempered_weights(docs)
    got = mixing.mix(docs, weights, rest).collect()
    assert len({r.position for r in got}) == 6000 and laid[0] <= 50 + len(weights)
    total = sum(map(Fraction, weights.values()))
    assert all(r.release == r.block / (Fraction(weights[r.source]) / total) // 1 <= r.slot < r.deadline for r in got)  # the law, in larger blocks


def test_weights_too_far_apart_and_too_many_sources(spark, monkeypatch):
    docs = frame(spark, [(i, "t", "en", "ab"[i % 2], 1) for i in range(40)])
    with pytest.raises(ValueError, match="far apart"):
        mixing.mix(docs, {"a": 1.0, "b": 1e-25})
    assert mixing.mix(docs, {"a": 1.0, "b": 1e-9}).count() == 40
    monkeypatch.setattr(mixing, "MAX_SOURCES", 1)
    for call in (lambda: mixing.tempered_weights(docs), lambda: mixing.mix(docs, {"a": 1.0, "b": 1.0})):
        with pytest.raises(ValueError, match="more than 1"):
            call()


def test_null_ids_on_a_third_of_the_rows_are_spread(spark, monkeypatch):
    from pyspark.sql import functions as F

    from dimforge.llm import ranks

    seen = []
    monkeypatch.setattr(mixing, "gapless_rank", lambda df, groups, spread, *a, **kw: (seen.append(df.where("id IS NULL").groupBy(F.pmod(spread, F.lit(64))).count()), ranks.gapless_rank(df, groups, spread, *a, **kw))[1])
    docs = frame(spark, [(None if i % 3 == 0 else i, f"text {i}", "en", "s", 1) for i in range(6000)])
    assert len({r.position for r in mixing.mix(docs, {"s": 1.0}).collect()}) == 6000
    assert max(r["count"] for r in seen[0].collect()) < 80


def test_tempered_weights_and_whole_documents(spark):
    docs = frame(spark, repeated())
    weights, rest = mixing.tempered_weights(docs, max_sources=2)
    assert len(weights) == 2 and rest > 0
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert mixing.mixed_documents(frame(spark, [])).count() == 0


def deviation(weights, slots):
    """Greatest distance of any source from its target in blocks, over all slots while no source has run out."""
    total = sum(map(Fraction, weights))
    want, done, worst = [Fraction(w) / total for w in weights], [0] * len(weights), Fraction(0)
    for t, k in enumerate(slots):
        for x in (k,) if len(weights) > 100 else range(len(weights)):  # else before and after its own slots, where a source is farthest
            worst = max(worst, abs(done[x] - want[x] * t))
        done[k] += 1
        worst = max(worst, abs(done[k] - want[k] * (t + 1)))
    return worst


@pytest.mark.parametrize("weights", [[1.0] * 20, [0.1, 0.2, 0.7], [7.0 ** 0.5, 11.0 ** 0.5, 100.0], [50.0, *[1.0] * 50], [333333.0 ** 0.5, *[667.0 ** 0.5] * 1500]])
def test_exact_weights_stay_within_one_block_over_many_periods(weights):
    total, horizon = sum(weights), 20_000
    blocks = [int(w / total * horizon) + 2 for w in weights]
    laid = [x for x in mixing.edf(mixing.whole(weights), blocks) if x[4] < horizon]
    assert [x[4] for x in laid] == list(range(horizon)) and all(r <= slot < due for _, _, r, due, slot in laid)
    assert deviation(weights, [x[0] for x in laid]) < 1


def test_rows_follow_the_exact_weights_of_more_than_1024_sources(spark, monkeypatch):
    n = 1200
    data = [(i, "t", "en", "hot" if i % 3 == 0 else f"s{i % n}", 1) for i in range(9000)] + [(None, "t", "en", None, 1)] * 9
    docs = frame(spark, data)
    weights, rest = mixing.tempered_weights(docs)
    assert len(weights) == len({d[3] for d in data}) and rest == 0.0
    monkeypatch.setattr(mixing.scheduled, "__defaults__", (500,))  # in pieces
    got = mixing.mix(docs, weights, rest, block_rows=2).collect()
    assert len(got) == len(data) and len({r.position for r in got}) == len(data)
    total = sum(map(Fraction, weights.values()))
    for r in got:
        w = Fraction(weights[r.source]) / total
        assert r.release == r.block / w // 1 and r.deadline == -(-(r.block + 1) / w // 1) and r.release <= r.slot < r.deadline
    slots = {}
    for r in got:
        slots.setdefault((r.source, r.block), set()).add(r.slot)
    assert all(len(x) == 1 for x in slots.values()) and len({min(x) for x in slots.values()}) == len(slots)


def test_sources_without_a_weight_come_last(spark):
    docs = frame(spark, [(i, "t", "en", ("a", "b", "c", None)[i % 4], 1) for i in range(80)])
    got = sorted(mixing.mix(docs, {"a": 1.0, "b": 3.0}, block_rows=2).collect(), key=lambda r: r.position)
    assert len(got) == 80 and {r.source for r in got[:40]} == {"a", "b"} and {r.source for r in got[40:]} == {"c", None}
    assert sorted(r.doc_id for r in got) == list(range(80))
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0.0})
