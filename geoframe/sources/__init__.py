"""The ``filegdb`` data source (``filegdb``), its file layout and batch
kernels (``layout``, ``decode``), and catalog queries (``catalog``)."""
