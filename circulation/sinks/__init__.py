from circulation.sinks.delimited import write_delimited
from circulation.sinks.warehouse import CANONICAL, LOAD_DATE, LOAD_DAYS, ConcurrentRunError, Snapshot, Warehouse

__all__ = ["CANONICAL", "LOAD_DATE", "LOAD_DAYS", "ConcurrentRunError", "Snapshot", "Warehouse", "write_delimited"]
