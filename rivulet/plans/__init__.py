"""The registered queries on the driver's tables, each with its SQL twin."""
