"""The registered queries: every operator bound to the driver's tables, with its SQL twin."""
