from lakemill.catalogue.oracles import ORACLES
from lakemill.catalogue.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
