import base64
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from assetlens.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    # Tests run on a local master: the work folder is a fresh local one.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="assetlens-test-"))
    yield s
    s.stop()


def b64(text: str) -> str:
    return base64.b64encode(text.encode("utf-8")).decode("ascii")


@pytest.fixture(scope="session")
def logs(spark):
    """Builders of small hand-made change logs (unit fixtures)."""
    from assetlens import schemas

    class Logs:
        @staticmethod
        def table_info(rows):
            # rows: (table_id, name, namespace, domain, creator, op, seq)
            return spark.createDataFrame(
                [(r[0], r[1], r[2], r[3], r[4], r[5], r[6]) for r in rows],
                schemas.TABLE_INFO_CHANGES)

        @staticmethod
        def partitions(rows):
            # rows: (table_id, partition_desc, op, seq)
            return spark.createDataFrame(rows, schemas.PARTITION_CHANGES)

        @staticmethod
        def commits(rows):
            # rows: (table_id, commit_id, [file op texts], committed, op, seq)
            return spark.createDataFrame(
                [(r[0], r[1], None if r[2] is None else [b64(x) for x in r[2]], r[3], r[4], r[5])
                 for r in rows], schemas.COMMIT_CHANGES)

    return Logs
