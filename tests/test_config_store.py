"""Config versions merged on write: flags equal the derived view, untouched buckets stay."""

import os
import random

from tidemill.operators import configs as C
from tidemill.operators.config_store import ConfigStore

SCHEMA = "id long, client_id long, feature_type string, created_at string, is_active boolean, window_days int"


def versions(rng, ids, clients=6):
    return [(i, rng.randrange(clients), rng.choice(["ema", "lags"]), rng.choice([None, "2024-01-01", "2024-01-02", "2024-02-01"]), True, i) for i in ids]


def data_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(os.path.join(path, "data")) for f in fs if f.endswith(".parquet")}


def test_merges_equal_the_derived_view(spark, tmp_path):
    rng = random.Random(4)
    store = ConfigStore(spark, str(tmp_path / "configs"), buckets=4)
    parts = [versions(rng, range(20)), versions(rng, range(20, 24)), [], versions(rng, range(24, 40)), [(40, None, None, None, False, 1), (41, None, None, "2024-01-01", True, 1)]]
    every = []
    for part in parts + [parts[0][:5]]:
        every += [r for r in part if r not in every]
        before, (run, held) = data_files(store.table.path), store.table.manifest()
        touched = store.merge(spark.createDataFrame(part + part[:2], SCHEMA))
        after = store.table.manifest()
        assert before.items() <= data_files(store.table.path).items()
        assert {b: r for b, r in after[1].items() if b not in touched} == {b: r for b, r in held.items() if b not in touched}
        assert after[0] == run + bool(touched)
        want = C.config_versions(spark.createDataFrame(every, SCHEMA)) if every else None
        got = {r["id"]: r["is_current"] for r in store.read().collect()}
        assert got == {r["id"]: r["is_current"] for r in want.collect()}
    assert store.read().columns == [*spark.createDataFrame([], SCHEMA).columns, "is_current"]
