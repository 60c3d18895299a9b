"""The searchable fields: five built-in ones and registered text extensions."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

RunText = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class TextField:
    """One searchable field. ``text`` maps runs to (project, number, text); built-ins have none."""

    key: str
    default_searchable: bool = True
    stored: bool = True
    exact: bool = False
    text: RunText | None = None


BUILT_IN = (
    TextField("j"),
    TextField("n", default_searchable=False, exact=True),
    TextField("d"),
    TextField("p"),
    TextField("c"),
)

_RESERVED = {"project", "number"}


class FieldRegistry:
    """Built-in fields plus the extensions of one deployment."""

    def __init__(self) -> None:
        self._fields: dict[str, TextField] = {f.key: f for f in BUILT_IN}

    def register_text_field(
        self, keyword: str, text: RunText, persist: bool = False, default_searchable: bool = True
    ) -> TextField:
        if not re.fullmatch(r"[a-z][a-z0-9_]*", keyword):
            raise ValueError(f"keyword {keyword!r} must be lower case letters, digits or _")
        if keyword in self._fields or keyword in _RESERVED:
            raise ValueError(f"keyword {keyword!r} is taken")
        field = TextField(keyword, default_searchable, persist, False, text)
        self._fields[keyword] = field
        return field

    @property
    def all(self) -> list[TextField]:
        return list(self._fields.values())

    @property
    def extensions(self) -> list[TextField]:
        return [f for f in self.all if f.text is not None]

    @property
    def all_keys(self) -> list[str]:
        return [f.key for f in self.all]

    @property
    def default_keys(self) -> list[str]:
        return [f.key for f in self.all if f.default_searchable]

    @property
    def exact_keys(self) -> set[str]:
        return {f.key for f in self.all if f.exact}

    @property
    def stored_keys(self) -> list[str]:
        return [f.key for f in self.all if f.stored]
