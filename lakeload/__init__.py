"""Schema-driven bulk loading of delimited text into analytical tables, on Spark."""

from lakeload.plans.load import LoadFailed, LoadResult, load_all, load_table
from lakeload.plans.schemas import Registry, tpcds
from lakeload.plans.spec import LoadSpec
from lakeload.session import build_session, session_conf

__all__ = [
    "LoadFailed",
    "LoadResult",
    "LoadSpec",
    "Registry",
    "build_session",
    "load_all",
    "load_table",
    "session_conf",
    "tpcds",
]
