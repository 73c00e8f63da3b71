"""Every constant of the metrics, as parameters with their default values."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: money tiers, bin edges, labels and thresholds of the reports ---
CARGO_TIERS = ((200, "40.99"), (350, "78.99"), (None, "93.05"))  # (net below, fee)
AMOUNT_EDGES = (0, 100, 150, 200, 250, 300, 350, 400, 500, 750, 100000)
AMOUNT_LABELS = ("<100", "100-149", "150-199", "200-249", "250-299", "300-349", "350-399", "400-499", "500-749", "750+")
DELIVERY_EDGES = (0, 2, 3, 4, 5, 7, 30)
DELIVERY_LABELS = ("≤2", "2-3", "3-4", "4-5", "5-7", "7+")
GAP_EDGES = (0, 7, 14, 30, 60, 90, 200)
CLIFF_BANDS = ((180, 200), (200, 230), (330, 350), (350, 380))
FIRST_ORDER = "1.Sipariş"
RETURNED_STATUS = "İade edildi"
OTHER_CATEGORY = "Diğer"
# coupon presets: name, minimum basket, discount, use %, step-up %, extra orders %
COUPON_PRESETS = (
    ("Takipçi A", 0, 15, 5, 0, 1.5),
    ("Takipçi B", 400, 50, 5, 3, 1.5),
    ("Üründen Kazan", 350, 30, 35, 10, 3),
    ("Örnek", 200, 10, 35, 10, 3),
    ("Sepete ekleyenler", 250, 25, 4, 0, 1.5),
    ("Yorum Yap", 250, 25, 8, 0, 2),
)
# cancellation and return reasons of the sales report; the marketplace's own name goes where {marketplace} stands
REASONS = (
    "Müşterinin İptal Ettiği", "{marketplace}'un İptal Ettiği", "Benim İptal Ettiğim", "Modelini Beğenmedim", "Kusurlu Ürün Gönderildi", "Yanlış Ürün Gönderildi", "Vazgeçtim", "Diğer",
    "Bedeni/Ebatı Küçük Geldi", "Bedeni/Ebatı Büyük Geldi", "Ürün ile Görsel & İçerik Bilgisi Uyuşmuyor",
    "Yanlış Sipariş Verdim", "Kalitesini Beğenmedim", "Teslim Edilemeyen Gönderi", "Gönderi Sevk Edilemedi", "Tazmin",
    "Taşıma Sürecinde İade Edildi", "Oluşmayan Gönderi Kodu", "Tedarik Edilemedi", "Kargo Teslimatı Gecikmesi",
    "Müşteri Onayı Tamamlanmayan Gönderi",
)
# --- end of fixed values ---


def cancel_reasons(marketplace: str) -> tuple[str, ...]:
    """The 21 reason headers of a sales report, for the marketplace that wrote it."""
    return tuple(r.replace("{marketplace}", marketplace) for r in REASONS)


@dataclass(frozen=True)
class Scenario:
    """Cost assumptions of a margin: cost ratio, VAT rate, fee per package, advertising counted or not."""

    cost: float = 0.40
    vat: float = 0.10
    fee: float = 10.99
    ads: bool = True


@dataclass(frozen=True)
class Params:
    """Reporting window and thresholds shared by the metrics."""

    months: tuple[str, ...] = ("2026-04", "2026-05", "2026-06", "2026-07", "2026-08", "2026-09")
    full_months: int = 5  # the leading months of the window that are complete
    elapsed_days: int = 22  # days passed in the last (snapshot) month
    observed_months: int = 5
    rising_min_revenue: float = 1500.0
    mover_min_revenue: float = 20000.0
    scenario: Scenario = field(default_factory=Scenario)

    @property
    def snapshot(self) -> str:
        return self.months[-1]


def scenario_grid() -> list[Scenario]:
    """Cost 30/40/50 %, VAT 10/20 %, two platform fees, advertising on and off."""
    return [
        Scenario(cost, vat, fee, ads)
        for cost in (0.30, 0.40, 0.50)
        for vat in (0.10, 0.20)
        for fee in (6.99, 10.99)
        for ads in (True, False)
    ]
