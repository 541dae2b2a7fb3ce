"""End-to-end flows (``flows``) and the driver-table query catalog (``catalog``)."""
