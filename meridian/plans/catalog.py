"""Every query of the library over the driver tables, by name, beside the SQL that gives the same rows."""

from __future__ import annotations

from meridian.plans import composite, inputs, relational, scalar, stories  # noqa: F401  they fill the registry
from meridian.plans.registry import QUERIES, SQL  # noqa: F401

FLAGSHIP = "snp_snapshot"
