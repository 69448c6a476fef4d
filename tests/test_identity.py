import random

import pytest

from footfall.operators import identity
from footfall.sources import Staging
from helpers import rows

EVENTS = "event_id bigint, timeStamp bigint, deviceId string, filledAccount string"


def sequential(events, accounts, devices, counter):
    """The rule, one event at a time."""
    accounts, devices, base, out = dict(accounts), dict(devices), counter, {}
    for event_id, _ts, device, account in sorted(events, key=lambda e: (e[1], e[0])):
        if account is not None and account in accounts:
            guid = accounts[account]
        elif device in devices:
            guid = devices[device]
            if account is not None:
                del devices[device]
                accounts[account] = guid
        else:
            counter += 1
            guid = counter
            (devices if account is None else accounts)[device if account is None else account] = guid
        out[event_id] = (guid, int(guid > base))
    store = [("A", k, g) for k, g in accounts.items()] + [("D", k, g) for k, g in devices.items()]
    return out, sorted([*store, ("C", "guid_cnt", counter)])


def random_case(seed, events=300, hot=0.0):
    rng = random.Random(seed)

    def device():
        return "d0" if rng.random() < hot else f"d{rng.randrange(12)}"

    log = [
        (i, rng.randrange(60_000), device(), None if rng.random() < 0.5 else f"u{rng.randrange(25)}") for i in range(events)
    ]
    return log, {"u0": 3, "u1": 7}, {f"d{i}": 10 + i for i in range(0, 10, 2)}, 20


def store_of(spark, accounts, devices, counter):
    data = [("A", k, g) for k, g in accounts.items()] + [("D", k, g) for k, g in devices.items()]
    return spark.createDataFrame([*data, ("C", "guid_cnt", counter)], identity.STORE_SCHEMA)


@pytest.mark.parametrize("seed,hot", [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.5), (4, 0.5), (5, 0.95)])
def test_equals_the_sequential_rule(spark, seed, hot):
    log, accounts, devices, counter = random_case(seed, hot=hot)
    expected, expected_store = sequential(log, accounts, devices, counter)
    store = store_of(spark, accounts, devices, counter)
    base = identity.stored_counter(store)
    assert base == counter
    events = spark.createDataFrame(log, EVENTS).repartition(3)
    resolved, next_store = identity.resolve(events, store, base, Staging(spark))
    assert {r["event_id"]: (r["guid"], r["isnew"]) for r in resolved.collect()} == expected
    assert sorted(rows(next_store)) == expected_store


def test_batches_follow_each_other(spark):
    log, accounts, devices, counter = random_case(7)
    log.sort(key=lambda e: (e[1], e[0]))
    store, got = store_of(spark, accounts, devices, counter), {}
    for batch in (log[:100], log[100:180], log[180:]):
        base = identity.stored_counter(store)
        stage = Staging(spark)
        resolved, following = identity.resolve(spark.createDataFrame(batch, EVENTS), store, base, stage)
        got.update({r["event_id"]: r["guid"] for r in resolved.collect()})
        store = stage(following, "store")
    expected, expected_store = sequential(log, accounts, devices, counter)
    assert got == {k: v[0] for k, v in expected.items()}
    assert sorted(rows(store)) == expected_store


def test_rerun_gives_the_same_ids(spark):
    log, accounts, devices, counter = random_case(8)
    store = store_of(spark, accounts, devices, counter)
    results = []
    for partitions in (1, 5):
        events = spark.createDataFrame(log, EVENTS).repartition(partitions)
        results.append(rows(identity.resolve(events, store, counter, Staging(spark))[0]))
    assert results[0] == results[1]


def test_empty_store_and_empty_batch(spark):
    empty_store = spark.createDataFrame([], identity.STORE_SCHEMA)
    assert identity.stored_counter(empty_store) == 0
    log = [(1, 10, "d", None), (2, 20, "d", "u"), (3, 30, "d", None), (4, 40, "e", "u")]
    resolved, store = identity.resolve(spark.createDataFrame(log, EVENTS), empty_store, 0, Staging(spark))
    assert rows(resolved, "event_id", "guid", "isnew") == [(1, 1, 1), (2, 1, 1), (3, 2, 1), (4, 1, 1)]
    assert rows(store) == [("A", "u", 1), ("C", "guid_cnt", 2), ("D", "d", 2)]
    resolved, store = identity.resolve(spark.createDataFrame([], EVENTS), store, 2, Staging(spark))
    assert resolved.count() == 0
    assert rows(store) == [("A", "u", 1), ("C", "guid_cnt", 2), ("D", "d", 2)]


def test_equal_times_and_no_unique_order(spark):
    log = [(1, 10, "d", None), (1, 10, "d", "u"), (1, 10, "d", "v"), (1, 10, "d", None)]
    store = spark.createDataFrame([], identity.STORE_SCHEMA)
    first = rows(identity.resolve(spark.createDataFrame(log, EVENTS), store, 0, Staging(spark))[0])
    again = rows(identity.resolve(spark.createDataFrame(log[::-1], EVENTS), store, 0, Staging(spark))[0])
    assert len(first) == 4 and first == again
