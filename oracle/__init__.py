"""The registered queries stated again as plain SQL for another engine, to compare results."""
