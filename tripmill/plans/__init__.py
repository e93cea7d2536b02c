"""Layer runs: the only place where jobs are started and tables written."""
