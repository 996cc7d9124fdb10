"""Column-level helpers: every function takes and returns ``Column``s."""

from ledgerline.functions.dates import (  # noqa: F401
    date_parts,
    parse_period,
)
from ledgerline.functions.money import (  # noqa: F401
    numeric_pct,
    quotient9,
    rate_pct,
    ratio2,
    round_money,
)
from ledgerline.functions.text import (  # noqa: F401
    clean_location,
    clean_town,
    email_key,
    extract_or_null,
    initcap_words,
    like_prefix,
    programme_label,
    ws_trim,
)
