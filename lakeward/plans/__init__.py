"""Job plans: domain specs, the bronze->silver pipeline, the DQ consolidation job."""
