"""Protocol names, table names and batch ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Protocol numbers that have a name.
PROTOCOLS = {0: "unknown", 1: "icmp", 6: "tcp", 17: "udp"}
#: Fixed value: an identifier of a table name.
_NAME = "[A-Za-z_][A-Za-z0-9_]*"


def protocol_name(protocol_id: Column) -> Column:
    name = protocol_id.cast("string")
    for number, text in PROTOCOLS.items():
        name = F.when(protocol_id == number, text).otherwise(name)
    return name


def valid_table_name(name: Column) -> Column:
    r"""One or two identifiers, with a dot between. ``\z`` and not ``$``, which a line end would satisfy too."""
    return F.coalesce(name.rlike(rf"\A{_NAME}(\.{_NAME})?\z"), F.lit(False))


def batch_id(file_name: Column, prefix: str = "batch-") -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(file_name, 256), 1, 24))
