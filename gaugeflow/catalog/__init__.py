"""All registered queries."""

from gaugeflow.catalog import models, monitoring, preparation, quality  # noqa: F401
from gaugeflow.catalog.registry import QUERIES, TWINS  # noqa: F401
