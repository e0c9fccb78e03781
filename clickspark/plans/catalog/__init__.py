"""Query catalog: importing this package registers every query."""

from clickspark.plans.catalog import (connectors, partitions, replay, rolling,  # noqa: F401
                                      transforms, windows)
