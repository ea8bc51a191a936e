"""Values as SQL text for remote databases."""

from __future__ import annotations

import datetime as dt


def literal(value: object, dialect: str | None = None) -> str:
    """A value as a SQL literal for a remote database.

    MySQL takes a backslash in a text for the start of an escape, others do not; where
    the ``dialect`` is not known, such texts are refused.
    """
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, int | float):
        return str(value)
    if isinstance(value, dt.date | str):
        text = str(value)
        if "\\" in text:
            if dialect is None:
                raise ValueError("a backslash needs the dialect of the database")
            text = text.replace("\\", "\\\\") if dialect == "mysql" else text
        return "'" + text.replace("'", "''") + "'"
    raise TypeError(f"no literal for {type(value).__name__}")
