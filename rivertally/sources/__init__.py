"""Reading, staging, guarded appends and exports."""
