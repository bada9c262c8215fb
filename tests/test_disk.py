"""Increments and streams need disk for their layers and one slice of a table: nothing else stays behind."""

from __future__ import annotations

import os
import time

from fixtures import RUN, customer, frame, hand_made
from tidemark.operators.lineage import with_lineage
from tidemark.plans import store as stores
from tidemark.plans.migration import ORDER
from tidemark.plans.store import CORE, EVALUATED, QUARANTINE, Store
from tidemark.schemas import CUSTOMER, ENTITIES
from tidemark.session import BRIEF_SHUFFLES, brief_shuffles, scratch_path, shared_folder
from tidemark.sources.raw import same_values, unseen
from tidemark.streaming.judged import stream_to_store


def stamped(tables):
    return {n: with_lineage(tables[n], ENTITIES[n], RUN.batch_id, RUN.instant("ingested_at")) for n in tables}


def contents(store):
    layers = ((layer, n) for layer in (EVALUATED, CORE, QUARANTINE) for n in ORDER)
    return {x: sorted(map(repr, store.current(*x).collect())) for x in layers}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def kept_aside(spark):
    return {f for f in os.listdir(shared_folder(spark).removeprefix("file:")) if f.startswith(("arrived-", "fresh-"))}


def test_slices_of_buckets_end_as_one_pass(spark, monkeypatch):
    tables = {n: t for n, t in stamped(hand_made(spark)).items() if n in ("customer", "account")}
    parts = [{n: t.where(f"pmod(xxhash64(source_record_key), 3) {x} 0") for n, t in tables.items()} for x in ("<>", "=")]
    whole, sliced = (Store(spark, scratch_path(spark, "store"), buckets=4) for _ in range(2))
    for part in parts:
        whole.merge(part, RUN)
    monkeypatch.setattr(stores, "SLICE_ROWS", 1)
    assert [len(s) for s in sliced._slices("customer", tables["customer"], {0, 1, 2, 3})] == [1] * 4
    for part in parts:
        sliced.merge(part, RUN)
    assert contents(sliced) == contents(whole)


def test_shuffles_of_a_merge_go_with_it(spark):
    before = shuffle_files(spark)
    customers = {"customer": stamped(hand_made(spark))["customer"]}
    Store(spark, scratch_path(spark, "store"), buckets=4).merge(customers, RUN)
    for _ in range(50):  # files are removed a moment later
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(BRIEF_SHUFFLES)
    with brief_shuffles(spark):
        assert spark.conf.get(BRIEF_SHUFFLES) == "true"
    assert spark.conf.get(BRIEF_SHUFFLES) == before


def test_a_stream_leaves_no_copy_of_its_rows(spark):
    before = kept_aside(spark)
    source, root, progress = (scratch_path(spark, x) for x in ("arriving", "bank", "progress"))
    for rows in ([customer(1), customer(1), customer(2)], [customer(2), customer(3)], [customer(3)]):
        frame(spark, "customer", rows).coalesce(1).write.mode("append").parquet(source)
        store = stream_to_store(spark, "customer", source, RUN, root, progress, buckets=4)
    assert store.current(EVALUATED, "customer").count() == 3
    assert kept_aside(spark) == before


def test_rows_are_the_same_in_every_value_or_not(spark):
    rows = [("a", "b"), ("a", None), (None, "a"), (None, None), ("", None), ("-", None), ("1:a", "b"), ("ab", ""), ("a", "b")]
    df = spark.createDataFrame(rows, "k STRING, h STRING")
    found = [bytes(r[0]) for r in df.select(same_values(df, ["k", "h"])).collect()]
    assert all((found[i] == found[j]) == (rows[i] == rows[j]) for i in range(9) for j in range(9))
    assert {len(x) for x in found} == {16}


def test_missing_keys_and_times_are_seen_once(spark):
    rows = frame(spark, "customer", [customer(1), customer(1), customer(None), customer(None), customer(2, updated_at=None)])
    own = with_lineage(rows, CUSTOMER, "B-1", RUN.instant("ingested_at"))
    same = ("source_record_key", "record_hash", "source_updated_at")
    assert unseen(own, own.limit(0), same).count() == 3
    assert unseen(own, own.where("customer_id = 2"), same).count() == 2
    assert unseen(own, own, same).columns == own.columns and unseen(own, own, same).isEmpty()
