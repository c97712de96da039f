"""Shipment status analytics as Spark DataFrame operators."""

from parcelwatch.plans.process import Settings, process_and_publish, process_shipments

__all__ = ["Settings", "process_and_publish", "process_shipments"]
