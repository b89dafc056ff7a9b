"""geoframe: read Esri File Geodatabase tables into Spark and work with their
geometries as ordinary Spark columns.

* ``geoframe.sources``    the ``filegdb`` batch data source and catalog queries
* ``geoframe.functions``  column functions (geometry structs, decoders)
* ``geoframe.operators``  DataFrame-level operators (segments, ordered scans,
                          table helpers, shape decoding)
* ``geoframe.plans``      the registered check queries and their SQL oracles
* ``geoframe.llm``        operators for training-data pipelines (optional)
* ``geoframe.testing``    a distributed geodatabase fixture writer (tests only)
"""

from geoframe.session import checkpoint_dir, get_session, register

__all__ = ["checkpoint_dir", "get_session", "register"]
__version__ = "0.1.0"
