import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sitepulse.schemas import schema  # noqa: E402
from sitepulse.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Plans show whole paths, however long the folder of the tests is.
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8",
                            spark__driver__memory="8g", spark__sql__maxMetadataStringLength="1000")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def t(text):
    """'31 10:00' -> 2024-01-31 10:00; a full date may be given as well."""
    if text is None:
        return None
    if len(text.split(" ")[0]) == 2:
        text = f"2024-01-{text}"
    return datetime.fromisoformat(text)


@pytest.fixture
def frame(spark):
    """frame('tickets', [{...}, ...]) with the declared schema, missing fields NULL."""
    def make(name, rows):
        fields = schema(name)
        full = [tuple(t(r[f.name]) if f.dataType.typeName() == "timestamp_ntz"
                      and isinstance(r.get(f.name), str) else r.get(f.name) for f in fields)
                for r in rows]
        return spark.createDataFrame(full, fields)

    return make


def rows(df, *columns):
    """Sorted tuples, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda r: [(v is not None, str(v)) for v in r])
