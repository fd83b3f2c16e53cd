"""Text dialects of delimited files."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class CsvDialect:
    """How one family of delimited files is written.

    ``strict_header`` makes a scan fail when a file's first line is not the
    header of the others. Without it, a part that lacks the header loses its
    first row and files with another column order are mixed up, both silently.
    Turn it off only for files whose header has blank or repeated names.
    ``multi_line`` lets a quoted value hold line breaks; a file is then read
    by one task.
    """

    sep: str = ";"
    encoding: str = "UTF-8"
    header: bool = True
    quote: str = '"'
    escape: str = "\\"
    line_sep: str | None = None
    quote_all: bool = False
    strict_header: bool = True
    multi_line: bool = False

    def with_(self, **changes) -> CsvDialect:
        return replace(self, **changes)

    def _common(self) -> dict[str, str]:
        options = {
            "sep": self.sep,
            "encoding": self.encoding,
            "header": str(self.header).lower(),
            "quote": self.quote,
            "escape": self.escape,
        }
        if self.line_sep is not None:
            options["lineSep"] = self.line_sep
        return options

    def read_options(self) -> dict[str, str]:
        options = self._common()
        if self.header and self.strict_header:
            options["enforceSchema"] = "false"
        if self.multi_line:
            options["multiLine"] = "true"
        return options

    def write_options(self) -> dict[str, str]:
        # The writer trims blanks around values unless told not to.
        return self._common() | {
            "quoteAll": str(self.quote_all).lower(),
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }

    def record_options(self) -> dict[str, str]:
        """Options for ``from_csv``, which sees one record and no file."""
        return {"sep": self.sep, "quote": self.quote, "escape": self.escape}


# Doubling the quote is the one escape that also survives a trailing backslash.
STAGED = CsvDialect(escape='"')
CONTROL = CsvDialect(sep="|", header=False, quote_all=True)
