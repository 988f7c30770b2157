"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode "cased" letters; a word is a run of them, so hyphens, quotes and
# digits all start a new one.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_PIECES = rf"([{_CASED}]+|[^{_CASED}]+)"


def title_case(text: Column) -> Column:
    """Capitalise every run of letters: ``BOSNIA-HERZEGOVINA`` → ``Bosnia-Herzegovina``.

    ``initcap`` alone capitalises after blanks only.
    """
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")
