"""flowspark: network-flow scoring, reporting and monitoring on Spark.

Layers: ``sources`` (flow tables, CSV/JSON, model bundles), ``functions``
(cleaning expressions), ``operators`` (preparation, scaling, sampling,
routing, reports, models, autoencoder, TreeSHAP), ``streaming`` (monitor),
``plans`` (registered queries and the retraining flow).  Command line:
``python -m flowspark retrain | score | report | explain``.
"""

__version__ = "0.1.0"
