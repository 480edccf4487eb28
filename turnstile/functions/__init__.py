"""turnstile.functions"""
