from .numbers import (  # noqa: F401
    finite,
    is_finite,
    label_of,
    lookup_bin,
    nan_to_null,
    rank_of,
    status_of,
    tally,
)
from .text import (  # noqa: F401
    clean_category,
    decimal_convention,
    normalize_decimal,
    parse_decimal,
    to_double,
)
