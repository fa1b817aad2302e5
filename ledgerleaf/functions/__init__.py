"""Column functions; all native expressions unless a docstring says otherwise."""
