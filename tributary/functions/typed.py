"""Records of a known shape, and XML records whole; inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The members of a record of the unified log of one operating system.
UNIFIED_LOG = (
    "traceID decimal(20,0), eventMessage string, eventType string, source variant, formatString string, activityIdentifier bigint, subsystem string, category string, threadID bigint, senderImageUUID string, "
    "backtrace struct<frames:array<struct<imageOffset:bigint,imageUUID:string>>>, bootUUID string, processImagePath string, timestamp string, senderImagePath string, machTimestamp bigint, messageType string, "
    "processImageUUID string, processID bigint, senderProgramCounter bigint, parentActivityIdentifier bigint, timezoneName string"
)


def typed(text: Column, schema: str) -> Column:
    """A struct of the members of a JSON record by a schema, and ``_misfit``: the whole text of a record that doesn't fit it.

    A member of another type is null, and the others are read. Members that the schema
    doesn't have are left out; absent ones are null. A text that is no JSON has nulls
    and itself for a misfit; a null gives a null.
    """
    return F.from_json(text, f"{schema}, _misfit string", {"columnNameOfCorruptRecord": "_misfit", "mode": "PERMISSIVE"})


def xml_record(document: Column) -> Column:
    """A VARIANT of an XML record: children by name, repeated ones as lists, attributes as ``_name``, text beside attributes as ``_VALUE``.

    Numbers and booleans are read as such, so ``007`` is 7: what must keep its spelling is taken by ``text.xml_value``.
    Empty elements are null. A document that isn't well formed, an empty and a null one give null.
    """
    return F.from_xml(document, "v variant", {"singleVariantColumn": "v", "mode": "PERMISSIVE"})["v"]
