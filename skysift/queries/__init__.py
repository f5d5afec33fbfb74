"""All registered queries; importing this package fills the registry."""

from skysift.queries import arrays, flagging, jobs, joining, planning, records, scalars, searching, sky, streams  # noqa: F401
from skysift.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
