"""Plan-level helpers shared by the operators: joins, calendar arithmetic, sessions."""
