"""The batch run and the register of named queries."""
