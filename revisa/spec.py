"""Revision spec: what the reference hard-codes as column lists becomes configuration."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RevisionSpec:
    """Describes one revisable table.

    ``kinds`` gives the value kind of a column for comparison and conversion:
    ``text`` (default), ``int`` (integer-like), ``type`` (two-value type code) or
    ``taxnode`` (``<prefix><digits>`` converted to an integer).
    ``updatable`` maps a data column to its target column name in the stored table,
    ``insertable`` lists ``(target, data column)`` pairs in insert order.
    """

    key: str
    columns: tuple[str, ...]
    key_pattern: str = r"^[A-Z]*(\d+)$"
    ordinal: str = "ord"
    read_only: tuple[str, ...] = ()
    updatable: tuple[tuple[str, str], ...] = ()
    insertable: tuple[tuple[str, str], ...] = ()
    kinds: tuple[tuple[str, str], ...] = ()
    blank_check: tuple[str, ...] = ()
    removal_column: str | None = None
    removal_marker: str = "abolish"
    list_column: str | None = None
    name_column: str | None = None
    context_columns: tuple[str, ...] = ()
    taxnode_pattern: str = r"^TX(\d+)$"
    type_codes: tuple[tuple[str, str], ...] = (("E", "EXEM"), ("A", "ADD"))
    skip_prefix: str = "QC_"
    # Q9: True reproduces the reference's update comparison, where two unreadable type
    # codes or two non-integers compare equal; False (default) falls back to the text.
    strict_reference: bool = False
    target_table: str = "records"
    # what the change text of a row without a key says
    new_label: str = "new isolate"

    def fallback(self, override: bool | None = None) -> bool:
        """Whether comparisons fall back to text for unreadable typed values."""
        return (not self.strict_reference) if override is None else override

    def kind(self, column: str) -> str:
        return dict(self.kinds).get(column, "text")

    def target(self, column: str) -> str:
        return dict(self.updatable)[column]

    def target_kind(self, target: str) -> str:
        """Kind of a target column (looked up through either mapping)."""
        for col, tgt in self.updatable:
            if tgt == target:
                return self.kind(col)
        for tgt, col in self.insertable:
            if tgt == target:
                return self.kind(col)
        return "text"

    @property
    def data_columns(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c != self.key)

    @property
    def compared_columns(self) -> tuple[str, ...]:
        """Columns the exact change summary looks at: all but the key and skipped ones."""
        return tuple(c for c in self.columns if c != self.key and not c.startswith(self.skip_prefix))

    @property
    def blank_columns(self) -> tuple[str, ...]:
        return self.blank_check or self.columns
