"""Column builders shared by every job. All are JVM-side expressions."""

from quaystone.functions.text import (  # noqa: F401
    blank_to_null, excel_int_text, first_nonempty, pick_column, strip_all, text_or_empty,
)
from quaystone.functions.numbers import (  # noqa: F401
    growth_rate, parse_number, rate, round_units,
)
