"""Arrivals in small batches.  The batch operators keep their meaning: rows carry the marks
of the steps that treated them, so a batch is only what has arrived since."""
