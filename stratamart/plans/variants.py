"""The four forms of the model as configuration instead of four code copies."""

from __future__ import annotations

from dataclasses import dataclass

from stratamart.functions.fx import BUNDLE_BOOK, DECLARATIVE_BOOK, NOTEBOOK_BOOK, FxBook


@dataclass(frozen=True)
class Variant:
    """What differs between the forms.

    ``active_only``: inactive products are filtered (else only warned about).
    ``book`` / ``amount_source``: currency book and the column it converts,
    from the order itself or from its payments. ``region_map`` and
    ``region_otherwise``: geography of the sales tables.
    """

    name: str
    active_only: bool
    book: FxBook | None
    amount_source: str
    region_map: str
    region_otherwise: str

    @property
    def sales_amount(self) -> str:
        return "total_amount" if self.book is None else "unified_amount"


PG = Variant("pg", True, None, "total_amount", "narrow", "Other")
NOTEBOOK = Variant("notebook", True, NOTEBOOK_BOOK, "total_amount", "wide", "Other (null)")
DECLARATIVE = Variant("declarative", False, DECLARATIVE_BOOK, "payment", "wide", "Other")
BUNDLE = Variant("bundle", False, BUNDLE_BOOK, "payment", "wide", "Other")

VARIANTS = {variant.name: variant for variant in (PG, NOTEBOOK, DECLARATIVE, BUNDLE)}
