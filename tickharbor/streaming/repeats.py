"""Messages that were delivered more than once, in a stream of bounded state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ARRIVED = "_arrived"


def without_repeats(
    messages: DataFrame, within: str = "10 minutes", keys: Sequence[str] = ("value",), arrived: str | None = None
) -> DataFrame:
    """The first of messages that agree in ``keys`` and arrive ``within`` some time of each other.

    The state holds the keys of that time only, and outlives restarts with the checkpoint. ``arrived`` names a column
    with the time of arrival (such as that of the broker): a message that lies further than ``within`` behind the
    newest one is dropped as late, and one without a time arrives when its batch begins. By default all messages do, so
    none is ever late, whatever the times inside it; a batch that is run again keeps the time it had.

    NULL keys are alike. The stream is shuffled by ``keys``, so all copies of one message meet in one task; where
    there is a short message id, name that as the key.
    """
    time = F.current_timestamp() if arrived is None else F.coalesce(arrived, F.current_timestamp())
    timed = messages.withColumn(_ARRIVED, time).withWatermark(_ARRIVED, within)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop(_ARRIVED)
