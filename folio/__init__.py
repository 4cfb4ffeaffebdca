"""folio: document-element processing as Spark DataFrame operators.

Every operator is a lazy function ``DataFrame -> DataFrame`` (or ``Column -> Column``
for the ones in :mod:`folio.functions`). Nothing here collects rows to the driver;
grouping, ordering and neighbour logic are expressed with joins, windows and
higher-order array functions so Catalyst can prune, push down and fuse them.
"""

from folio.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__version__ = "0.1.0"
