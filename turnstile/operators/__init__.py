"""turnstile.operators"""
