"""tillroll: retail inventory reporting as Spark DataFrame plans.

Two report jobs and their audits, re-expressed for Spark:

* ``plans.profit_job.profit_by_title`` -- one profit row per tracked item
  (receipts, store shipments, retail and wholesale sales, stock).
* ``plans.shipment_report.shipment_not_received`` -- shipments sent to stores
  whose received quantity does not sum to more than zero.

Operators live in ``operators``; scalar helpers in ``functions``; table
loading in ``sources``; join strategy and stage materialisation in ``plans``.
"""

__version__ = "0.1.0"
