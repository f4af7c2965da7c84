"""Row rendering as the reference prints rows (P10, K1, K2).

Fixed values: the text layouts of the three printed row types,
``SensorReading{id='<id>', timeStamp=<ms>, temperature=<double>}``,
``LogEvent{id='<id>', workpiece='<wp>', timeStamp=<ms>, content='<content>'}``,
``ProcessData{step1=(<name>,<ms>), step2=(...), step3=(...), step4=(...)}``,
and a labelled print prefixes ``<label>> ``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def render_sensor(id_: str = "id", ts: str = "time_stamp", temp: str = "temperature") -> Column:
    return F.concat(
        F.lit("SensorReading{id='"), _s(id_), F.lit("', timeStamp="), _s(ts), F.lit(", temperature="), _s(temp),
        F.lit("}"),
    )


def render_log_event(
    id_: str = "id", workpiece: str = "workpiece", ts: str = "time_stamp", content: str = "content"
) -> Column:
    return F.concat(
        F.lit("LogEvent{id='"), _s(id_), F.lit("', workpiece='"), _s(workpiece), F.lit("', timeStamp="), _s(ts),
        F.lit(", content='"), _s(content), F.lit("'}"),
    )


def render_process_data(names: Sequence[str], ts_suffix: str = "_ts") -> Column:
    parts: list[Column] = [F.lit("ProcessData{")]
    for i, n in enumerate(names):
        parts += [F.lit(("" if i == 0 else ", ") + f"{n}=("), F.lit(n), F.lit(","), _s(f"{n}{ts_suffix}"), F.lit(")")]
    parts.append(F.lit("}"))
    return F.concat(*parts)


def labelled(line: Column, label: str | Column | None) -> Column:
    """What ``print(label)`` writes with parallelism 1; no label prints the row alone."""
    if label is None:
        return line
    lab = F.lit(label) if isinstance(label, str) else label
    return F.concat(lab, F.lit("> "), line)
