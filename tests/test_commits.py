"""Several tables replaced as one step, whatever becomes of the run."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SF, rows
from predial.contracts import SCHEMAS, ContractError
from predial.plans import prices
from predial.plans import publish as publishing
from predial.sinks import commits, leases
from predial.sinks.folders import Folders
from predial.sinks.staging import Stage
from predial.sources.tables import read_period, read_table

OLD, NEW = "2025_2", "2026_1"
MATERIAL, USE, LINKS = (SCHEMAS[t] for t in ("codigo_material", "codigo_destino", "nexo_bc"))


class Killed(BaseException):
    """Not an Exception: nothing is cleared up, as when the driver dies."""


class Killing(Folders):
    def __init__(self, spark, root, renames):
        super().__init__(spark, root)
        self.left = renames

    def move(self, source, target):
        if self.left == 0:
            raise Killed
        self.left -= 1
        return super().move(source, target)


def lookups(spark, word):
    return {
        "codigo_material": spark.createDataFrame([(word, word)], MATERIAL),
        "codigo_destino": spark.createDataFrame([(word, word, word)], USE),
    }


def links(spark, *data):
    return spark.createDataFrame([(c, 1, 1, p, 1, 1, 1) for c, p in data], LINKS)


def seen(spark, root, read=None):
    read = read or (lambda path: read_table(spark, path))
    return {read(f"{root}/{t}").first()[0] for t in ("codigo_material", "codigo_destino")}


def test_killed_between_any_two_renames(spark, root):
    publishing.publish(lookups(spark, "v0"), root, root)
    states, number = [], 0
    while True:
        word, before = f"v{number + 1}", seen(spark, root)
        try:
            publishing.publish(lookups(spark, word), root, root, folders=Killing(spark, root, number))
        except Killed:
            after = seen(spark, root)
            assert len(after) == 1 and after <= before | {word}
            states.append(after == {word})
            commits.recover(spark, root)
            assert seen(spark, root, spark.read.parquet) == after  # also in the plain folders
            number += 1
            continue
        break
    # The first rename is the manifest's: killed at it, nothing counts; later, everything.
    assert states == [False, True, True, True, True]
    assert seen(spark, root, spark.read.parquet) == {word}


def test_killed_with_periods(spark, root):
    publishing.publish({"nexo_bc": links(spark, (1, OLD), (2, NEW), (3, "2024_1"))}, root, root,
                       [OLD, NEW, "2024_1"])
    for renames in range(1, 5):
        commits.recover(spark, root)
        with pytest.raises(Killed):
            publishing.publish({"nexo_bc": links(spark, (7, OLD), (renames, NEW))}, root, root,
                               [OLD, NEW], folders=Killing(spark, root, renames))
        df = read_table(spark, f"{root}/nexo_bc")
        assert sorted(r[0] for r in df.collect()) == sorted([7, renames, 3])
        assert rows(read_period(spark, f"{root}/nexo_bc", "nexo_bc", NEW))[0][0] == renames
    assert commits.begin(spark, root) == 5
    assert spark.read.parquet(f"{root}/nexo_bc").count() == 3
    left = [n for n in os.listdir(f"{root}/_commits") if not n.endswith(".crc")]
    assert all(n.endswith((".json", ".done")) for n in left)


def test_of_two_overlapping_runs_one_is_refused(spark, root):
    publishing.publish({"nexo_bc": links(spark, (1, OLD), (2, NEW))}, root, root, [OLD, NEW])
    since = commits.begin(spark, root)
    publishing.publish({"nexo_bc": links(spark, (3, NEW))}, root, root, [NEW], since=since)
    with pytest.raises(ContractError, match="periodo=2026_1: another run"):
        publishing.publish({"nexo_bc": links(spark, (4, NEW))}, root, root, [NEW], since=since)
    publishing.publish({"nexo_bc": links(spark, (5, OLD))}, root, root, [OLD], since=since)
    assert sorted(r[0] for r in read_table(spark, f"{root}/nexo_bc").collect()) == [3, 5]
    assert not [n for n in os.listdir(f"{root}/_commits") if n.startswith("run-")]


def test_a_run_that_is_staged_while_another_publishes(spark, root):
    with commits.Publication(spark, root) as slow:
        lookups(spark, "slow")["codigo_material"].write.parquet(slow.staged("codigo_material"))
        slow.replaces("codigo_material")
        publishing.publish(lookups(spark, "fast"), root, root)
        with pytest.raises(ContractError, match="another run"):
            slow.commit()
    assert seen(spark, root) == {"fast"}


def test_old_versions_are_forgotten_and_then_refuse(spark, root, monkeypatch):
    monkeypatch.setattr(commits, "KEPT", 1)
    since = commits.begin(spark, root)
    for word in ("a", "b", "c"):
        publishing.publish(lookups(spark, word), root, root)
    with pytest.raises(ContractError, match="have published meanwhile"):
        publishing.publish({"nexo_bc": links(spark, (4, NEW))}, root, root, [NEW], since=since)


def test_one_changed_value_is_found(spark, root, monkeypatch):
    check = publishing.check_written_table

    def tampered(spark, path, *rest):
        files = [n for n in os.listdir(path) if n.endswith(".parquet")]
        name = next(n for n in files if pq.read_metadata(f"{path}/{n}").num_rows)
        table = pq.read_table(f"{path}/{name}")
        words = table.column(1).to_pylist()
        words[0] += "x"
        changed = table.set_column(1, table.schema[1].name, pa.array(words))
        pq.write_table(changed, f"{path}/{name}")
        os.unlink(f"{path}/.{name}.crc")
        return check(spark, path, *rest)

    publishing.publish(lookups(spark, "good"), root, root)
    monkeypatch.setattr(publishing, "check_written_table", tampered)
    with pytest.raises(ContractError, match="other values read back"):
        publishing.publish(lookups(spark, "bad"), root, root)
    assert seen(spark, root) == {"good"}


def test_checksum_minds_nulls_repeats_and_columns(spark):
    from predial.sinks.guards import checksum

    def of(*data):
        df = spark.createDataFrame(data, "a string, b string").repartition(3)
        return df.agg(*checksum(["a", "b"])).first()

    assert of(("x", None), ("y", "z")) == of(("y", "z"), ("x", None))
    for other in ((("x", "x"),), ((None, "x"),), (("x", None), ("x", None)), (("x", None), (None, None))):
        assert of(("x", None)) != of(*other)


def test_leases(spark, tmp_path):
    def folder(name):
        return f"{tmp_path}/{name}"

    own = leases.Lease(spark, folder("own"), expiry=2.0)
    alive = leases.Lease(spark, folder("alive"), expiry=2.0)
    killed = leases.Lease(spark, folder("killed"), expiry=2.0)
    killed.release()
    os.makedirs(folder("foreign"))
    assert own.sweep(str(tmp_path)) == []
    time.sleep(3.5)
    assert own.sweep(str(tmp_path)) == ["killed"]
    assert sorted(os.listdir(tmp_path)) == ["alive", "foreign", "own"]
    own.release()
    alive.release()


def test_a_killed_stage_goes_with_the_next_one(spark, monkeypatch):
    monkeypatch.setattr(leases, "EXPIRY", 1.0)
    killed = Stage(spark, "killed").__enter__()
    killed.keep(spark.range(3), "rows")
    killed.lease.release()
    time.sleep(2.5)
    with Stage(spark, "next"):
        assert not os.path.exists(killed.folder)


def test_sales_are_joined_once_and_audited_on_the_way(spark, root, monkeypatch):
    from predial.plans import jobs
    from workload import registry, views

    base = registry.replaceable_folder(spark, "audited")
    registry.job_prices(spark, SF)  # leaves the sources beside its output
    source = registry.replaceable_folder(spark, "audited").replace("audited", "job_prices")
    joins, join = [], prices.join_lookup
    monkeypatch.setattr(prices, "join_lookup", lambda *a: joins.append(1) or join(*a))
    _, audit = jobs.run_prices(spark, f"{source}/raw", root, root)
    assert len(joins) == 1 and not os.path.exists(base)
    typed = prices.type_sales(views.raw_sales(spark, SF))
    rates = prices.type_rates(views.raw_rates(spark, SF))
    want = prices.sales_audit(typed, prices.rate_reference(rates), prices.check_rates(rates))
    assert audit == want.first().asDict()
