"""Results follow the files: a rerun after the input changed, and settings that lose data."""

from __future__ import annotations

import shutil

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01
from eventide import session

NAMES = ["late_share", "late_user_events", "category_affinity", "batch_stream_divergence"]


def _oracle(folder, name):
    con = duckdb.connect()
    for t in ("events", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    rel = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    return sorted((tuple(_norm(r[cols.index(c)]) for c in sorted(cols)) for r in rel.fetchall()), key=repr)


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", NAMES)
def test_rerun_after_the_files_were_replaced(spark, tmp_path, name):
    for source in (SF001, SF01):
        for t in ("events", "part"):
            shutil.copyfile(f"{source}/{t}.parquet", tmp_path / f"{t}.parquet")
        spark.catalog.refreshByPath(str(tmp_path))
        df = entry.queries()[name](spark, str(tmp_path))
        got = sorted((tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
        assert got == _oracle(tmp_path, name)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


class _Cluster:
    """What ``checkpoint_root`` asks of a session, on a cluster without the setting."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getConf():
            return {}

        @staticmethod
        def getCheckpointDir():
            return None

    conf = {}


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Cluster)
    assert session.is_local("local[4]") and not session.is_local("local-cluster[3,2,1024]")
