"""Reading raw folders and reading/publishing warehouse tables."""
