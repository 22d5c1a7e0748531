"""revisa: curate large tables through versioned edits, as Spark DataFrame plans."""

from revisa.spec import RevisionSpec

__all__ = ["RevisionSpec"]
