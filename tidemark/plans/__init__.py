"""The warehouse tables as DataFrame plans, and the jobs that build them."""
