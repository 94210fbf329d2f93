"""Declared target schemas, source-to-target column mappings, write configs
and extraction catalogues.

Everything between the ``FIXED VALUES`` markers is data that must equal the
source system's contract (table names, column names, types, write modes, key
lists).  It is stated as plain text in natural order and parsed once into
Python structures below.  ``int`` columns are stored as bigint, ``tinyint``
holds 0-255, ``datetime`` has no time zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------- FIXED VALUES
ACCOUNTING_TARGETS = """
CrediteurenOpenstaand: ID:int AdministratieCode:int RelatieID:nvarchar Valuta:nvarchar Bedrag:decimal Omschrijving:nvarchar BoekstukNummer:nvarchar FactuurNummer:nvarchar Referentie:nvarchar FactuurDatum:date VervalDatum:date
DebiteurenOpenstaand: ID:int AdministratieCode:int RelatieID:nvarchar Valuta:nvarchar Bedrag:decimal Omschrijving:nvarchar BoekstukNummer:nvarchar FactuurNummer:nvarchar Referentie:nvarchar FactuurDatum:date VervalDatum:date
GrootboekRubriek: ID:uniqueidentifier AdministratieCode:int RubriekCode:nvarchar Naam:nvarchar ParentID:nvarchar GrootboekSchema:nvarchar
Grootboekrekening: ID:uniqueidentifier AdministratieCode:int Grootboekrekeningen:nvarchar Grootboek:nvarchar BalansType:nvarchar DebetCredit:nvarchar GrootboekIndelingID:nvarchar GrootboekIndeling:nvarchar KostenplaatsID:nvarchar Kostenplaats:nvarchar KostenDragerID:nvarchar KostenDrager:nvarchar
Relaties: ID:uniqueidentifier AdministratieCode:int RelatieCode:nvarchar KlantSinds:date KlantNaam:nvarchar Adres:nvarchar Postcode:nvarchar Plaats:nvarchar Provincie:nvarchar Land:nvarchar Relatiebeheerder:nvarchar BusinessType:nvarchar BusinessSector:nvarchar BusinessSubSector:nvarchar RelatieGroep:nvarchar RelatieGroepID1:nvarchar RelatieGroepID2:nvarchar RelatieGroepID3:nvarchar RelatieGroepID4:nvarchar RelatieGroepID5:nvarchar RelatieGroepID6:nvarchar RelatieGroepID7:nvarchar RelatieGroepID8:nvarchar RelatieGroepOmschrijving:nvarchar Parent:nvarchar IsSupplier:bit IsPurchase:bit Status:nvarchar
RelatieKeten: ID:uniqueidentifier AdministratieCode:int ClassificatieNaam:nvarchar Code:nvarchar Omschrijving:nvarchar
Budget: ID:uniqueidentifier AdministratieCode:int BudgetScenario:nvarchar GrootboekID:nvarchar Kostenplaats:nvarchar Kostendrager:nvarchar Artikel:nvarchar Boekjaar:int Boekperiode:int Bedrag:decimal
GrootboekMapping: ID:uniqueidentifier AdministratieCode:int GrootboekRubriekID:nvarchar GrootboekID:nvarchar GrootboekMappingSchema:nvarchar
ReportingBalance: ID:int AdministratieCode:int GrootboekID:nvarchar ReportingPeriod:int ReportingYear:int AantalMutaties:int KostenPlaats:nvarchar KostenDrager:nvarchar BalansType:nvarchar Bedrag:decimal BedragCredit:decimal BedragDebit:decimal
GrootboekMutaties: ID:uniqueidentifier AdministratieCode:int GrootboekID:nvarchar RelatieID:nvarchar Datum:date Boekjaar:int BoekPeriode:int Omschrijving:nvarchar BoekstukNummer:nvarchar FactuurNummer:nvarchar OrderNummer:nvarchar Referentie:nvarchar Valuta:nvarchar Bedrag:decimal BTWBedrag:decimal BTWPercentage:decimal Type:int KostenplaatsID:nvarchar Kostenplaats:nvarchar KostenDragerID:nvarchar KostenDrager:nvarchar DocumentID:uniqueidentifier
Voorraad: ID:uniqueidentifier HuidigeVoorraad:decimal AdministratieCode:int ArtikelID:nvarchar ArtikelEindDatum:date ArtikelStartDatum:date ArtikelEenheid:nvarchar ArtikelEenheidOmschrijving:nvarchar MaximaleVoorraad:decimal GeplandeInkomendeVoorraad:decimal GeplandeUitgaandeVoorraad:decimal VerwachteVoorraad:decimal GereserveerdeVoorraad:decimal Veiligheidsvoorraad:decimal MagazijnID:nvarchar MagazijnCode:nvarchar MagazijnOmschrijving:nvarchar
Artikelen: ID:uniqueidentifier StandaardVerkoopprijs:decimal Categorie1:nvarchar Categorie2:nvarchar Categorie3:nvarchar Categorie4:nvarchar Categorie5:nvarchar Categorie6:nvarchar Categorie7:nvarchar Categorie8:nvarchar Categorie9:nvarchar Categorie10:nvarchar Artikelcode:nvarchar Valuta:nvarchar NieuweKostprijs:decimal StandaardKostprijs:decimal GemiddeldeKostprijs:decimal AangemaaktOp:date Artikelomschrijving:nvarchar AdministratieCode:int Einddatum:date ExtraOmschrijving:nvarchar VrijBooleanVeld1:bit VrijBooleanVeld2:bit VrijBooleanVeld3:bit VrijBooleanVeld4:bit VrijBooleanVeld5:bit VrijDatumVeld1:date VrijDatumVeld2:date VrijDatumVeld3:date VrijDatumVeld4:date VrijDatumVeld5:date VrijNummerVeld1:decimal VrijNummerVeld2:decimal VrijNummerVeld3:decimal VrijNummerVeld4:decimal VrijNummerVeld5:decimal VrijNummerVeld6:decimal VrijNummerVeld7:decimal VrijNummerVeld8:decimal VrijTekstVeld1:nvarchar VrijTekstVeld2:nvarchar VrijTekstVeld3:nvarchar VrijTekstVeld4:nvarchar VrijTekstVeld5:nvarchar VrijTekstVeld6:nvarchar VrijTekstVeld7:nvarchar VrijTekstVeld8:nvarchar VrijTekstVeld9:nvarchar VrijTekstVeld10:nvarchar Artikelgroep:nvarchar IsMaakartikel:tinyint IsNieuwContract:tinyint IsOpAanvraagArtikel:tinyint IsVerpakkingArtikel:bit IsInkoopArtikel:bit IsVerkoopArtikel:bit IsSerieArtikel:bit IsVoorraadArtikel:bit IsOnderaannemerArtikel:bit IsBelastingArtikel:tinyint IsTijdArtikel:tinyint IsWebshopArtikel:tinyint BrutoGewicht:decimal NettoGewicht:decimal NettoGewichtEenheid:nvarchar Notities:nvarchar BTWcode:nvarchar BTWcodeBeschrijving:nvarchar Beveiligingsniveau:int Startdatum:date GoederenCode:nvarchar Eenheid:nvarchar EenheidBeschrijving:nvarchar EenheidType:nvarchar
ArtikelenExtraVelden: ArtikelID:nvarchar GewijzigdOp:date Nummer:int Omschrijving:nvarchar Waarde:nvarchar AdministratieCode:int
ArtikelGroepen: ID:uniqueidentifier Code:nvarchar Omschrijving:nvarchar AdministratieCode:int
Verkoopfacturen: F_Valuta:nvarchar F_VersturenNaarID:nvarchar F_Omschrijving:nvarchar F_AdministratieCode:int F_Factuurdatum:date F_FactuurID:nvarchar F_Factuurnummer:int F_FactuurNaarID:nvarchar F_Orderdatum:date F_BesteldDoorID:nvarchar F_BetaalconditieBeschrijving:nvarchar F_Opmerkingen:nvarchar F_VerzendmethodeBeschrijving:nvarchar F_StatusBeschrijving:nvarchar F_UwReferentie:nvarchar F_StartVerkoopfactuurStatus:nvarchar FR_Bedrag:decimal FR_Kostenplaats:nvarchar FR_Kostendrager:nvarchar FR_Leverdatum:date FR_Omschrijving:nvarchar FR_Korting:decimal FR_WerknemerNaam:nvarchar FR_GrootboekrekeningID:nvarchar FR_FactuurregelID:uniqueidentifier FR_ArtikelID:nvarchar FR_Regelnummer:int FR_Aantal:decimal FR_VerkooporderID:nvarchar FR_VerkooporderRegelID:nvarchar FR_EenheidBeschrijving:nvarchar FR_Eenheidsprijs:decimal FR_BTWBedrag:decimal FR_BTWPercentage:decimal
VerkoopOrders: O_ApprovalStatusBeschrijving:nvarchar O_Goedgekeurd:date O_GoedgekeurdDoorNaam:nvarchar O_Aangemaakt:date O_AangemaaktDoorNaam:nvarchar O_Valuta:nvarchar O_VersturenNaarID:nvarchar O_Omschrijving:nvarchar O_AdministratieCode:int O_FactuurStatusBeschrijving:nvarchar O_FactuurNaarID:nvarchar O_Orderdatum:date O_BesteldDoorNaam:nvarchar O_OrderID:nvarchar O_Ordernummer:int O_Opmerkingen:nvarchar O_VerzendmethodeBeschrijving:nvarchar O_StatusBeschrijving:nvarchar O_UwReferentie:nvarchar OR_Bedrag:decimal OR_Kostenplaats:nvarchar OR_Kostprijs:decimal OR_Kostendrager:nvarchar OR_Leverdatum:date OR_Omschrijving:nvarchar OR_Korting:decimal OR_OrderRegelID:uniqueidentifier OR_ArtikelID:nvarchar OR_Regelnummer:int OR_Aantal:decimal OR_BTWBedrag:decimal OR_BTWPercentage:decimal
Verkoopkansen: VerkoopkansID:uniqueidentifier AccountID:nvarchar Actiedatum:date Bedrag:decimal Sluitingsdatum:date Aangemaakt:date AangemaaktDoorNaam:nvarchar Valuta:nvarchar AdministratieCode:int Naam:nvarchar FaseBeschrijving:nvarchar Status:int Kans:decimal EigenaarNaam:nvarchar VerkooptypeBeschrijving:nvarchar RedenBeschrijving:nvarchar CampagneBeschrijving:nvarchar LeadBronBeschrijving:nvarchar ContactpersoonNaam:nvarchar
Offertes: O_AdministratieCode:int O_OfferteID:nvarchar O_Offertenummer:int O_Versie:int OR_OfferteRegelID:uniqueidentifier O_Medewerker:nvarchar O_Valuta:nvarchar O_Omschrijving:nvarchar O_Status:nvarchar O_RelatieID:nvarchar O_VerkoopKansID:nvarchar O_OfferteDatum:date O_VervalDatum:date O_EindDatum:date O_AfleverDatum:date O_Opmerkingen:nvarchar O_UwReferentie:nvarchar OR_Bedrag:decimal OR_Kostenplaats:nvarchar OR_Kostendrager:nvarchar OR_Omschrijving:nvarchar OR_Korting:decimal OR_ArtikelID:nvarchar OR_Regelnummer:int OR_Aantal:decimal OR_Eenheid:nvarchar OR_PrijsPerEenheid:decimal OR_BTWBedrag:decimal OR_BTWPercentage:decimal
Divisions: Division:int Entiteit:nvarchar CustomerCode:int CustomerName:nvarchar State:nvarchar City:nvarchar HID:nvarchar CompanySizeDescription:nvarchar
Documenten: ID:uniqueidentifier AdministratieCode:int Categorie_omschrijving:nvarchar Documentdatum:date Document_URL:nvarchar GrootboekmutatieID:uniqueidentifier Is_leeg:bit Gewijzigd_op:date Factuur_nummer:int Document_type:int
"""

ERP_TARGETS = """
GrootboekRubriek: OmgevingID:int Grootboek_RubriekID:nvarchar Rubriek_Code:nvarchar Rubriek:nvarchar Balanscode:nvarchar Soort:nvarchar Hoofdgroep_Code:nvarchar HoofdgroepID:nvarchar Hoofdgroep_Omschrijving:nvarchar Subgroep_Code:nvarchar SubgroepID:nvarchar Subgroep_Omschrijving:nvarchar Subgroep2_Code:nvarchar Subgroep2ID:nvarchar Subgroep2_Omschrijving:nvarchar
Grootboekrekening: OmgevingID:int Administratie_Code:int GrootboekID:nvarchar Type_RekeningID:nvarchar Type_Rekening_Omschrijving:nvarchar Kenmerk_RekeningID:nvarchar Kenmerk_Rekening_Omschrijving:nvarchar Omschrijving:nvarchar Soort_Rekening:nvarchar Rubriek_Code:nvarchar Balans_Code:nvarchar Gewijzigd_Op:date Intercompany:bit
Budget: OmgevingID:int Administratie_Code:int Budget_Scenario_Code:nvarchar Budget_Scenario:nvarchar GrootboekID:nvarchar Boekjaar:int Boekperiode:int Datum:date Bedrag:decimal KostenplaatsID:nvarchar KostendragerID:nvarchar
GrootboekMutaties: OmgevingID:int Administratie_Code:int Boekjaar:int Code_Dagboek:nvarchar Nummer_Journaalpost:int Volgnummer_Journaalpost:int GrootboekID:nvarchar RelatieID:nvarchar Datum:date Boekperiode:int Omschrijving:nvarchar Boekstuk_Nummer:nvarchar Factuur_Nummer:nvarchar Order_Nummer:nvarchar Valuta:nvarchar Bedrag:decimal BTW_Bedrag:decimal BTW_Percentage:decimal Type_Boeking:nvarchar Type_Mutatie:nvarchar Dagboek_Soort:nvarchar KostenplaatsID:nvarchar KostendragerID:nvarchar Gewijzigd_Op:datetime AbonnementID:int AbonnementID2:int
Divisions: OmgevingID:int Administratie_Code:int Administratie_Naam:nvarchar
Medewerkers: OmgevingID:int Administratie_Code:int GUID:uniqueidentifier Medewerker:nvarchar Start_Datum:date Eind_Datum:date Geslacht:nvarchar Functie:nvarchar Type_Functie:nvarchar AfdelingID:nvarchar Afdeling:nvarchar
Projecten: OmgevingID:int Administratie_Code:int Project_Classificatie:nvarchar ProjectID:nvarchar Project:nvarchar Project_Type:nvarchar Project_Status:nvarchar Project_Status_Code:int Projectleider_GUID:uniqueidentifier Uitvoerend_Consultant_GUID:uniqueidentifier Opdrachtnemer_GUID:uniqueidentifier Organisatie_ID:int OpdrachtgeverID:nvarchar RelatieID:int Contactpersoon:nvarchar HoofdprojectID:nvarchar Hoofdproject_Omschrijving:nvarchar Hoofdproject_Status_Code:int Hoofdproject_Status:nvarchar Start_Datum:date Voorcalculatie_Uren:decimal Voorcalculatie_Kostprijs:decimal Nacalculatie_Uren:decimal Nacalculatie_Kostprijs:decimal Eind_Datum_Planning:date Eind_Datum:date Voortgang_Percentage:decimal Decharge_Verzonden:bit Afgemeld:bit Gewijzigd_Op:datetime Termijnbedrag:decimal Totale_aanneemsom:decimal Fixed_Price_Project:bit Gereed:bit Doorbelasten:bit WBSO:nvarchar Termijnen:int Gefactureerd:decimal Te_factureren:decimal
Relaties: OmgevingID:int Soort_Contact:nvarchar Naam:nvarchar Inkooprelatie:bit Verkooprelatie:bit Medewerker:bit Medewerker_GUID:uniqueidentifier VerkooprelatieID:int InkooprelatieID:int RelatieNummer:int
Urenregistratie: OmgevingID:int Administratie_Code:int Urenregistratie_GUID:uniqueidentifier ProjectID:nvarchar Project_ActiviteitID:nvarchar RelatieID:int Medewerker_GUID:uniqueidentifier Uur_SoortID:int Datum:date Datum_gewijzigd:date Aantal:decimal Valuta_Code:nvarchar Prijs:decimal Bedrag:decimal Geaccordeerd:bit Gereedgemeld:bit Gefactureerd:bit Kostprijs:decimal Kostprijs_Bedrag:decimal Doorbelasten:bit Uur_Type:int Uur_Type_Detail:nvarchar
Verlof: OmgevingID:int Administratie_Code:int Medewerker_GUID:uniqueidentifier Verlof:nvarchar Start_Datum:date Eind_Datum:date Verlof_Uren:decimal Verlof_Type:nvarchar AfdelingID:nvarchar
VerzuimUren: OmgevingID:int Administratie_Code:int Medewerker_GUID:uniqueidentifier Verzuim:nvarchar Start_Datum:datetime Eind_Datum:datetime Verzuim_Uren:decimal Aanwezigheid_Percentage:decimal Verzuim_Type:nvarchar Status:decimal AfdelingID:nvarchar
VerzuimVerloop: OmgevingID:int Verzuimmelding_GUID:uniqueidentifier Verzuimverloop_GUID:uniqueidentifier Medewerker_GUID:uniqueidentifier Gewijzigd_Op:datetime Datum:datetime Vangnet_Regeling:bit Aanwezigheid_Percentage:decimal
Contracten: OmgevingID:int Administratie_Code:int Arbeids_ContractID:int Medewerker_GUID:uniqueidentifier Medewerker_Type:nvarchar Start_Datum:date Eind_Datum:date Proeftijd_Eind_Datum:date Contract_Type:nvarchar Volgnummer:int AfdelingID:nvarchar Meedere_Dienstverbanden:bit Aantal_FTE:decimal Dagen_Per_Week:decimal Uren_Per_Week:decimal
Abonnementen: OmgevingID:int Administratie_Code:int AbonnementID:int Licentiehouder:nvarchar RelatieID:int Abonnement_Type:nvarchar Item:nvarchar Licentie_Type:nvarchar Aantal:decimal Eenheid:nvarchar Prijs:decimal Waarde:decimal Begin_Regel:date Start_Datum:date Eind_Regel:date Eind_Datum:date Gefactureerd_Tot:date Gefactureerd_Vanaf:date Gecrediteerd:bit Crediteren_Vanaf:date Cyclus_Code:nvarchar Cyclus:nvarchar Cyclus_Begin:date Gewijzigd_Op:datetime
CaseLogging: OmgevingID:int Administratie_Code:int Logregel:int DossierID:int ForecastID:int ActieID:int Volgende_Actie:nvarchar Begin_Datum:datetime Uitvoer_Datum:datetime Gekozen_Actie:nvarchar Doorlooptijd_Sec:decimal Doorlooptijd_Uur:decimal Gewijzigd_Op:datetime Omschrijving:nvarchar
Dossiers: OmgevingID:int Administratie_Code:int DossierID:int Dossier_Nummer:int Instuur_Datum:date Onderwerp:nvarchar Aanmaker:nvarchar AanmakerID:int Verantwoordelijke:nvarchar VerantwoordelijkeID:int Potentiele_Omzet:decimal Oplossing:nvarchar Volgende_Actie:nvarchar Prioriteit:nvarchar Forecast:nvarchar Huidige_Status:nvarchar Datum_Afgehandeld:datetime Gewijzigd_Op:datetime Organisatie_Naam:nvarchar OrganisatieID:int ForecastID:int Eind_Datum:datetime Bevinding:nvarchar Prioriteit_Herstelcase:nvarchar Reactie_Datum:datetime TypeDossieritemID:int TypeDossieritemOmschrijving:nvarchar Woonplaats:nvarchar Postcode:nvarchar
Forecasts: OmgevingID:int Administratie_Code:int ForecastID:int OrganisatieID:int Organisatie_Naam:nvarchar Start_Datum:date Eind_Datum_Verwacht:date Eind_Datum:date Forecast_Bedrag:decimal Verwacht_Bedrag:decimal Verantwoordelijke_GUID:uniqueidentifier Omschrijving:nvarchar Forecastgroep_Code:int Forecastgroep:nvarchar Datum_Laatste_Wijziging:datetime Status:nvarchar Voortgang:nvarchar RPA_Diensten:decimal RPA_Licentie:decimal Bruto_Omzet:decimal Aantal_Uren:decimal Scoringskans:decimal Oplossing:nvarchar Type_Abonnement_Code_Verwacht:int Type_Abonnement_Verwacht:nvarchar Gewijzigd_Op:datetime
Nacalculatie: OmgevingID:int Administratie_Code:int Nacalculatie_GUID:uniqueidentifier Datum:date Boekjaar:int Periode:int ProjectID:nvarchar Project_Naam:nvarchar Projectgroep:nvarchar Project_Type:nvarchar Start_Datum:date Organisatie:nvarchar OrganisatieID:int RelatieID:int Uitvoerend_Consultant_GUID:uniqueidentifier Medewerker_GUID:uniqueidentifier Uren:decimal Omschrijving:nvarchar Werksoort_Type:int Werksoort:nvarchar Integratiegroep_Code:nvarchar Integratiegroep:nvarchar Afdeling_Code:nvarchar Geaccordeerd:bit Doorbelasten:bit Gefactureerd:bit Verkoop_Bedrag:decimal Uurprijs_Verkoop:decimal Item_Code:nvarchar Item_Omschrijving:nvarchar Innovatie:nvarchar WBSO:bit Jira_Ticket_Nummer:nvarchar Gewijzigd_Op:datetime Kostprijs:decimal Kostprijs_Bedrag:decimal Uur_Type:int Uur_Type_Detail:nvarchar Project_ActiviteitID:nvarchar Valuta_Code:nvarchar Gereedgemeld:bit
Roosters: OmgevingID:int Administratie_Code:int Medewerker_Naam:nvarchar Medewerker_GUID:uniqueidentifier Type:nvarchar Datum:date Uren:decimal FTE:decimal Parttime_Percentage:decimal Afdeling_Code:nvarchar Gewijzigd_Op:datetime Pro_forma:bit
Tarieven: OmgevingID:int Administratie_Code:int ProjectID:nvarchar Verkoopprijs:decimal
"""

PAYROLL_TARGETS = """
Bedrijven: BedrijfID:int Bedrijfsnummer:int Bedrijfsnaam:nvarchar
Looncomponenten: BedrijfID:int Bedrijfsnummer:int Bedrijfsnaam:nvarchar WerknemerID:int Werknemer_nummer:int LooncomponentID:int Looncomponent_nummer:int Looncomponentnaam:nvarchar Looncomponentwaarde:decimal Periode:int Jaar:int Run:int
"""

MAPPINGS = """
accounting CrediteurenOpenstaand: HID>ID, Division>AdministratieCode, AccountId>RelatieID, CurrencyCode>Valuta, Amount>Bedrag, Description>Omschrijving, EntryNumber>BoekstukNummer, InvoiceNumber>FactuurNummer, YourRef>Referentie, InvoiceDate>FactuurDatum, DueDate>VervalDatum
accounting DebiteurenOpenstaand: HID>ID, Division>AdministratieCode, AccountId>RelatieID, CurrencyCode>Valuta, Amount>Bedrag, Description>Omschrijving, EntryNumber>BoekstukNummer, InvoiceNumber>FactuurNummer, YourRef>Referentie, InvoiceDate>FactuurDatum, DueDate>VervalDatum
accounting GrootboekMutaties: ID, Division>AdministratieCode, GLAccount>GrootboekID, Account>RelatieID, Date>Datum, FinancialYear>Boekjaar, FinancialPeriod>BoekPeriode, Description>Omschrijving, EntryNumber>BoekstukNummer, InvoiceNumber>FactuurNummer, OrderNumber>OrderNummer, PaymentReference>Referentie, Currency>Valuta, AmountDC>Bedrag, AmountVATFC>BTWBedrag, VATPercentage>BTWPercentage, Type, CostCenter>KostenplaatsID, CostCenterDescription>Kostenplaats, CostUnit>KostenDragerID, CostUnitDescription>KostenDrager, Document>DocumentID
accounting GrootboekRubriek: ID, Division>AdministratieCode, Code>RubriekCode, Description>Naam, Parent>ParentID, TaxonomyNamespaceDescription>GrootboekSchema
accounting Grootboekrekening: ID, Division>AdministratieCode, Code>Grootboekrekeningen, Description>Grootboek, BalanceType>BalansType, BalanceSide>DebetCredit, Type>GrootboekIndelingID, TypeDescription>GrootboekIndeling, Costcenter>KostenplaatsID, CostcenterDescription>Kostenplaats, Costunit>KostenDragerID, CostunitDescription>KostenDrager
accounting Relaties: ID, Division>AdministratieCode, Code>RelatieCode, CustomerSince>KlantSinds, Name>KlantNaam, AddressLine1>Adres, Postcode, City>Plaats, StateName>Provincie, CountryName>Land, AccountManagerFullName>Relatiebeheerder, BusinessType, ActivitySector>BusinessSector, ActivitySubSector>BusinessSubSector, Classification>RelatieGroep, Classification1>RelatieGroepID1, Classification2>RelatieGroepID2, Classification3>RelatieGroepID3, Classification4>RelatieGroepID4, Classification5>RelatieGroepID5, Classification6>RelatieGroepID6, Classification7>RelatieGroepID7, Classification8>RelatieGroepID8, ClassificationDescription>RelatieGroepOmschrijving, Parent, IsPurchase>IsSupplier, IsSupplier>IsPurchase, Status
accounting RelatieKeten: ID, Division>AdministratieCode, AccountClassificationNameDescription>ClassificatieNaam, Code, Description>Omschrijving
accounting Budget: ID, AmountDC>Bedrag, BudgetScenarioDescription>BudgetScenario, CostcenterDescription>Kostenplaats, CostunitDescription>Kostendrager, Division>AdministratieCode, GLAccount>GrootboekID, ItemDescription>Artikel, ReportingPeriod>Boekperiode, ReportingYear>Boekjaar
accounting GrootboekMapping: ID, Classification>GrootboekRubriekID, Division>AdministratieCode, GLAccount>GrootboekID, GLSchemeDescription>GrootboekMappingSchema
accounting ReportingBalance: ID, Amount>Bedrag, AmountCredit>BedragCredit, AmountDebit>BedragDebit, BalanceType>BalansType, CostCenterDescription>KostenPlaats, CostUnitDescription>KostenDrager, Count>AantalMutaties, Division>AdministratieCode, GLAccount>GrootboekID, ReportingPeriod, ReportingYear
accounting Voorraad: ID, CurrentStock>HuidigeVoorraad, Division>AdministratieCode, Item>ArtikelID, ItemEndDate>ArtikelEindDatum, ItemStartDate>ArtikelStartDatum, ItemUnit>ArtikelEenheid, ItemUnitDescription>ArtikelEenheidOmschrijving, MaximumStock>MaximaleVoorraad, PlannedStockIn>GeplandeInkomendeVoorraad, PlannedStockOut>GeplandeUitgaandeVoorraad, ProjectedStock>VerwachteVoorraad, ReservedStock>GereserveerdeVoorraad, SafetyStock>Veiligheidsvoorraad, Warehouse>MagazijnID, WarehouseCode>MagazijnCode, WarehouseDescription>MagazijnOmschrijving
accounting Artikelen: ID, StandardSalesPrice>StandaardVerkoopprijs, Class_01>Categorie1, Class_02>Categorie2, Class_03>Categorie3, Class_04>Categorie4, Class_05>Categorie5, Class_06>Categorie6, Class_07>Categorie7, Class_08>Categorie8, Class_09>Categorie9, Class_10>Categorie10, Code>Artikelcode, CostPriceCurrency>Valuta, CostPriceNew>NieuweKostprijs, CostPriceStandard>StandaardKostprijs, AverageCost>GemiddeldeKostprijs, Created>AangemaaktOp, Description>Artikelomschrijving, Division>AdministratieCode, EndDate>Einddatum, ExtraDescription>ExtraOmschrijving, FreeBoolField_01>VrijBooleanVeld1, FreeBoolField_02>VrijBooleanVeld2, FreeBoolField_03>VrijBooleanVeld3, FreeBoolField_04>VrijBooleanVeld4, FreeBoolField_05>VrijBooleanVeld5, FreeDateField_01>VrijDatumVeld1, FreeDateField_02>VrijDatumVeld2, FreeDateField_03>VrijDatumVeld3, FreeDateField_04>VrijDatumVeld4, FreeDateField_05>VrijDatumVeld5, FreeNumberField_01>VrijNummerVeld1, FreeNumberField_02>VrijNummerVeld2, FreeNumberField_03>VrijNummerVeld3, FreeNumberField_04>VrijNummerVeld4, FreeNumberField_05>VrijNummerVeld5, FreeNumberField_06>VrijNummerVeld6, FreeNumberField_07>VrijNummerVeld7, FreeNumberField_08>VrijNummerVeld8, FreeTextField_01>VrijTekstVeld1, FreeTextField_02>VrijTekstVeld2, FreeTextField_03>VrijTekstVeld3, FreeTextField_04>VrijTekstVeld4, FreeTextField_05>VrijTekstVeld5, FreeTextField_06>VrijTekstVeld6, FreeTextField_07>VrijTekstVeld7, FreeTextField_08>VrijTekstVeld8, FreeTextField_09>VrijTekstVeld9, FreeTextField_10>VrijTekstVeld10, ItemGroup>Artikelgroep, IsMakeItem>IsMaakartikel, IsNewContract>IsNieuwContract, IsOnDemandItem>IsOpAanvraagArtikel, IsPackageItem>IsVerpakkingArtikel, IsPurchaseItem>IsInkoopArtikel, IsSalesItem>IsVerkoopArtikel, IsSerialItem>IsSerieArtikel, IsStockItem>IsVoorraadArtikel, IsSubcontractedItem>IsOnderaannemerArtikel, IsTaxableItem>IsBelastingArtikel, IsTime>IsTijdArtikel, IsWebshopItem>IsWebshopArtikel, GrossWeight>BrutoGewicht, NetWeight>NettoGewicht, NetWeightUnit>NettoGewichtEenheid, Notes>Notities, SalesVatCode>BTWcode, SalesVatCodeDescription>BTWcodeBeschrijving, SecurityLevel>Beveiligingsniveau, StartDate>Startdatum, StatisticalCode>GoederenCode, Unit>Eenheid, UnitDescription>EenheidBeschrijving, UnitType>EenheidType
accounting ArtikelenExtraVelden: ItemID>ArtikelID, Modified>GewijzigdOp, Number>Nummer, Description>Omschrijving, Value>Waarde, Division>AdministratieCode
accounting ArtikelGroepen: ID, Code, Description>Omschrijving, Division>AdministratieCode
accounting Verkoopfacturen: Currency>F_Valuta, DeliverTo>F_VersturenNaarID, Invoice_Description>F_Omschrijving, Division>F_AdministratieCode, InvoiceDate>F_Factuurdatum, InvoiceID>F_FactuurID, InvoiceNumber>F_Factuurnummer, InvoiceTo>F_FactuurNaarID, OrderDate>F_Orderdatum, OrderedBy>F_BesteldDoorID, PaymentConditionDescription>F_BetaalconditieBeschrijving, Remarks>F_Opmerkingen, ShippingMethodDescription>F_VerzendmethodeBeschrijving, StatusDescription>F_StatusBeschrijving, YourRef>F_UwReferentie, StarterSalesInvoiceStatusDescription>F_StartVerkoopfactuurStatus, AmountDC>FR_Bedrag, CostCenterDescription>FR_Kostenplaats, CostUnitDescription>FR_Kostendrager, DeliveryDate>FR_Leverdatum, Description>FR_Omschrijving, Discount>FR_Korting, EmployeeFullName>FR_WerknemerNaam, GLAccount>FR_GrootboekrekeningID, ID>FR_FactuurregelID, Item>FR_ArtikelID, LineNumber>FR_Regelnummer, Quantity>FR_Aantal, SalesOrder>FR_VerkooporderID, SalesOrderLine>FR_VerkooporderRegelID, UnitDescription>FR_EenheidBeschrijving, UnitPrice>FR_Eenheidsprijs, VATAmountDC>FR_BTWBedrag, VATPercentage>FR_BTWPercentage
accounting VerkoopOrders: ApprovalStatusDescription>O_ApprovalStatusBeschrijving, Approved>O_Goedgekeurd, ApproverFullName>O_GoedgekeurdDoorNaam, Created>O_Aangemaakt, CreatorFullName>O_AangemaaktDoorNaam, Currency>O_Valuta, DeliverTo>O_VersturenNaarID, Order_Description>O_Omschrijving, Division>O_AdministratieCode, InvoiceStatusDescription>O_FactuurStatusBeschrijving, InvoiceTo>O_FactuurNaarID, OrderDate>O_Orderdatum, OrderedBy>O_BesteldDoorNaam, OrderID>O_OrderID, OrderNumber>O_Ordernummer, Remarks>O_Opmerkingen, ShippingMethodDescription>O_VerzendmethodeBeschrijving, StatusDescription>O_StatusBeschrijving, YourRef>O_UwReferentie, AmountDC>OR_Bedrag, CostCenterDescription>OR_Kostenplaats, CostPriceFC>OR_Kostprijs, CostUnitDescription>OR_Kostendrager, DeliveryDate>OR_Leverdatum, Description>OR_Omschrijving, Discount>OR_Korting, ID>OR_OrderRegelID, Item>OR_ArtikelID, LineNumber>OR_Regelnummer, Quantity>OR_Aantal, VATAmount>OR_BTWBedrag, VATPercentage>OR_BTWPercentage
accounting Verkoopkansen: ID>VerkoopkansID, Account>AccountID, ActionDate>Actiedatum, AmountDC>Bedrag, CloseDate>Sluitingsdatum, Created>Aangemaakt, CreatorFullName>AangemaaktDoorNaam, Currency>Valuta, Division>AdministratieCode, Name>Naam, OpportunityStageDescription>FaseBeschrijving, OpportunityStatus>Status, Probability>Kans, OwnerFullName>EigenaarNaam, SalesTypeDescription>VerkooptypeBeschrijving, ReasonCodeDescription>RedenBeschrijving, CampaignDescription>CampagneBeschrijving, LeadSourceDescription>LeadBronBeschrijving, ContactFullName>ContactpersoonNaam
accounting Offertes: Division>O_AdministratieCode, QuotationID>O_OfferteID, QuotationNumber>O_Offertenummer, VersionNumber>O_Versie, ID>OR_OfferteRegelID, SalesPersonFullName>O_Medewerker, Currency>O_Valuta, Quotation_Description>O_Omschrijving, StatusDescription>O_Status, OrderAccount>O_RelatieID, Opportunity>O_VerkoopKansID, QuotationDate>O_OfferteDatum, ClosingDate>O_VervalDatum, CloseDate>O_EindDatum, DeliveryDate>O_AfleverDatum, Remarks>O_Opmerkingen, YourRef>O_UwReferentie, AmountDC>OR_Bedrag, CostCenterDescription>OR_Kostenplaats, CostUnitDescription>OR_Kostendrager, Discount>OR_Korting, Item>OR_ArtikelID, LineNumber>OR_Regelnummer, Quantity>OR_Aantal, UnitDescription>OR_Eenheid, UnitPrice>OR_PrijsPerEenheid, VATAmountFC>OR_BTWBedrag, VATPercentage>OR_BTWPercentage, Description>OR_Omschrijving
accounting Divisions: Division, Entiteit, CustomerCode, CustomerName, State, City, HID, CompanySizeDescription
accounting Documenten: ID, Division>AdministratieCode, CategoryDescription>Categorie_omschrijving, DocumentDate>Documentdatum, DocumentViewUrl>Document_URL, FinancialTransactionEntryID>GrootboekmutatieID, HasEmptyBody>Is_leeg, Modified>Gewijzigd_op, SalesInvoiceNumber>Factuur_nummer, Type>Document_type
payroll Bedrijven: ID>BedrijfID, Number>Bedrijfsnummer, Name>Bedrijfsnaam
payroll Looncomponenten: CompanyID>BedrijfID, CompanyNumber>Bedrijfsnummer, CompanyName>Bedrijfsnaam, EmployeeID>WerknemerID, EmployeeNumber>Werknemer_nummer, ComponentGuid>LooncomponentID, ComponentNumber>Looncomponent_nummer, ComponentName>Looncomponentnaam, ComponentValue>Looncomponentwaarde, Period>Periode, Jaar, Run
"""

WRITE_CONFIGS = """
accounting | Voorraad | none | ID | AdministratieCode
accounting | Grootboekrekening | none | ID | AdministratieCode
accounting | GrootboekRubriek | truncate | ID | AdministratieCode
accounting | GrootboekMutaties | none | ID | AdministratieCode
accounting | CrediteurenOpenstaand | truncate | ID | AdministratieCode
accounting | DebiteurenOpenstaand | truncate | ID | AdministratieCode
accounting | Relaties | none | ID | AdministratieCode
accounting | RelatieKeten | none | ID | AdministratieCode
accounting | Budget | none | ID | AdministratieCode
accounting | GrootboekMapping | truncate | ID | AdministratieCode
accounting | ReportingBalance | reporting_year | ID | AdministratieCode
accounting | Artikelen | none | ID | AdministratieCode
accounting | ArtikelenExtraVelden | none | ArtikelID, Nummer | AdministratieCode
accounting | ArtikelGroepen | none | ID | AdministratieCode
accounting | Verkoopfacturen | none | FR_FactuurregelID | F_AdministratieCode
accounting | VerkoopOrders | none | OR_OrderRegelID | O_AdministratieCode
accounting | Verkoopkansen | none | VerkoopkansID | AdministratieCode
accounting | Offertes | none | O_Versie, OR_OfferteRegelID | O_AdministratieCode
accounting | Divisions | none | Division | —
accounting | Documenten | none | ID | AdministratieCode
ERP | Grootboekrekening | truncate | OmgevingID, GrootboekID | Administratie_Code
ERP | GrootboekRubriek | truncate | OmgevingID, Grootboek_RubriekID | —
ERP | GrootboekMutaties | none | OmgevingID, Boekjaar, Code_Dagboek, Nummer_Journaalpost, Volgnummer_Journaalpost | Administratie_Code
ERP | Budget | truncate | OmgevingID, Budget_Scenario_Code, GrootboekID, Boekjaar, Boekperiode | Administratie_Code
ERP | Divisions | truncate | OmgevingID | Administratie_Code
ERP | Medewerkers | truncate | OmgevingID, Administratie_Code, GUID | Administratie_Code
ERP | Relaties | truncate | OmgevingID, Naam | —
ERP | Projecten | truncate | OmgevingID, Administratie_Code, ProjectID | Administratie_Code
ERP | Urenregistratie | truncate | OmgevingID, Administratie_Code, Urenregistratie_GUID | Administratie_Code
ERP | Verlof | truncate | — | Administratie_Code
ERP | VerzuimVerloop | truncate | OmgevingID, Verzuimmelding_GUID | —
ERP | VerzuimUren | truncate | — | Administratie_Code
ERP | Contracten | truncate | OmgevingID, Administratie_Code, Medewerker_GUID, Arbeids_ContractID | Administratie_Code
ERP | Abonnementen | truncate | — | Administratie_Code
ERP | CaseLogging | none | OmgevingID, Administratie_Code, Logregel | Administratie_Code
ERP | Dossiers | none | OmgevingID, Administratie_Code, DossierID, Dossier_Nummer | Administratie_Code
ERP | Forecasts | none | OmgevingID, Administratie_Code, ForecastID | Administratie_Code
ERP | Roosters | none | OmgevingID, Administratie_Code, Medewerker_GUID, Datum | Administratie_Code
ERP | Nacalculatie | none | OmgevingID, Administratie_Code, Nacalculatie_GUID | Administratie_Code
ERP | Tarieven | truncate | OmgevingID, Administratie_Code, ProjectID | Administratie_Code
payroll | Bedrijven | truncate | BedrijfID | —
payroll | Looncomponenten | truncate | BedrijfID, WerknemerID, LooncomponentID | BedrijfID, Jaar
"""
# Extraction catalogues (E5).  One line per table:
#   source mode table: filter column and operator kind, line list column
# filter kinds: modified (watermark >=), modified_day (watermark floored to
# the day), reporting_year (>= reporting year), window_date (>= full-window
# start), window_year (>= year of the full-window start), none.
CATALOGUE = """
accounting reset Documenten: Modified modified
accounting reset Offertes: - none QuotationLines
accounting reset ArtikelenExtraVelden: Modified modified
accounting reset Grootboekrekening: Modified modified
accounting reset Artikelen: - none
accounting reset ReportingBalance: ReportingYear reporting_year
accounting reset VerkoopOrders: - none SalesOrderLines
accounting reset Verkoopfacturen: - none SalesInvoiceLines
accounting reset Voorraad: Modified modified
accounting reset ArtikelGroepen: Modified modified
accounting reset Verkoopkansen: Modified modified
accounting reset RelatieKeten: Modified modified
accounting reset Relaties: Modified modified
accounting reset Budget: Modified modified
accounting reset CrediteurenOpenstaand: - none
accounting reset DebiteurenOpenstaand: - none
accounting reset GrootboekMapping: - none
accounting reset GrootboekRubriek: - none
accounting reset GrootboekMutaties: Modified modified
accounting regular Documenten: Modified modified
accounting regular Offertes: Modified modified QuotationLines
accounting regular ArtikelenExtraVelden: Modified modified
accounting regular Grootboekrekening: Modified modified
accounting regular Artikelen: Modified modified
accounting regular ReportingBalance: ReportingYear reporting_year
accounting regular VerkoopOrders: Modified modified SalesOrderLines
accounting regular Verkoopfacturen: Modified modified SalesInvoiceLines
accounting regular Voorraad: Modified modified
accounting regular ArtikelGroepen: Modified modified
accounting regular Verkoopkansen: Modified modified
accounting regular RelatieKeten: Modified modified
accounting regular Relaties: Modified modified
accounting regular Budget: Modified modified
accounting regular CrediteurenOpenstaand: - none
accounting regular DebiteurenOpenstaand: - none
accounting regular GrootboekMapping: - none
accounting regular GrootboekRubriek: - none
accounting regular GrootboekMutaties: Modified modified
accounting full Budget: Modified window_date
accounting full Documenten: Modified window_date
accounting full Verkoopfacturen: InvoiceDate window_date SalesInvoiceLines
accounting full VerkoopOrders: OrderDate window_date SalesOrderLines
accounting full GrootboekMutaties: FinancialYear window_year
erp regular Forecasts: Gewijzigd_Op modified
erp regular Divisions: - none
erp regular GrootboekMutaties: Gewijzigd_Op modified
erp regular Grootboekrekening: - none
erp regular GrootboekRubriek: - none
erp regular Budget: - none
erp regular Projecten: - none
erp regular Abonnementen: - none
erp regular Relaties: - none
erp regular Nacalculatie: Gewijzigd_Op modified_day
erp regular Urenregistratie: - none
erp regular Verlof: - none
erp regular VerzuimUren: - none
erp regular VerzuimVerloop: - none
erp regular Medewerkers: - none
erp regular Contracten: - none
erp regular CaseLogging: Gewijzigd_Op modified
erp regular Dossiers: Gewijzigd_Op modified
erp regular Roosters: Gewijzigd_Op modified
erp regular Tarieven: - none
erp full Forecasts: - none
erp full Divisions: - none
erp full GrootboekMutaties: - none
erp full Grootboekrekening: - none
erp full GrootboekRubriek: - none
erp full Budget: - none
erp full Projecten: - none
erp full Abonnementen: - none
erp full Relaties: - none
erp full Nacalculatie: - none
erp full Urenregistratie: - none
erp full Verlof: - none
erp full VerzuimUren: - none
erp full VerzuimVerloop: - none
erp full Medewerkers: - none
erp full Contracten: - none
erp full CaseLogging: - none
erp full Dossiers: - none
erp full Roosters: - none
erp full Tarieven: - none
"""

# The older catalogues (E5).  Accounting: the current one without the named tables; ERP: its own tables.
OLDER_WITHOUT = {"reset": ("Documenten",), "regular": ("Documenten",), "full": ("Documenten", "Budget")}
OLDER_ERP = """
erp_o regular Divisions: - none
erp_o regular GrootboekMutaties: Gewijzigd_Op modified
erp_o regular Grootboekrekening: - none
erp_o regular GrootboekRubriek: - none
erp_o regular Budget: - none
erp_o regular BudgetProjecten: - none
erp_o regular Urenregistratie: - none
erp_o regular Verlof: - none
erp_o regular VerzuimUren: - none
erp_o regular VerzuimVerloop: - none
erp_o regular Medewerkers: - none
erp_o regular Projecten: - none
erp_o regular Relaties: - none
erp_o regular Contracten: - none
erp_o full GrootboekMutaties: Boekjaar window_year
"""

# Header and line fields of the three nested sales documents (D1-D3).  The
# header's ``Description`` is renamed to ``<Prefix>_Description``.
NESTED_DOCUMENTS = """
Verkoopfacturen SalesInvoiceLines Invoice: Currency DeliverTo Description Division InvoiceDate InvoiceID InvoiceNumber InvoiceTo OrderDate OrderedBy PaymentConditionDescription Remarks ShippingMethodDescription StatusDescription YourRef StarterSalesInvoiceStatusDescription | AmountDC CostCenterDescription CostUnitDescription DeliveryDate Description Discount EmployeeFullName GLAccount ID Item LineNumber Quantity SalesOrder SalesOrderLine UnitDescription UnitPrice VATAmountDC VATPercentage
VerkoopOrders SalesOrderLines Order: ApprovalStatusDescription Approved ApproverFullName Created CreatorFullName Currency DeliverTo Description Division InvoiceStatusDescription InvoiceTo OrderDate OrderedBy OrderID OrderNumber Remarks ShippingMethodDescription StatusDescription YourRef | AmountDC CostCenterDescription CostPriceFC CostUnitDescription DeliveryDate Description Discount ID Item LineNumber Quantity VATAmount VATPercentage
Offertes QuotationLines Quotation: QuotationID QuotationNumber VersionNumber SalesPersonFullName Currency Description StatusDescription OrderAccount Opportunity QuotationDate ClosingDate CloseDate DeliveryDate Remarks YourRef | AmountDC CostCenterDescription CostUnitDescription Description Discount ID Item LineNumber Quantity UnitDescription UnitPrice VATAmountFC VATPercentage
"""

# Sync thresholds and fixed dates.
RESET_AFTER_YEARS = {"accounting": 2.0, "accounting_o": 1.2, "erp": 2.0}
STALE_DELETE_AFTER_YEARS = {"accounting": 2.0, "erp": 1.2, "payroll": 1.2}
FULL_RESYNC_WATERMARK = "2000-01-01T00:00:00"
FULL_RESYNC_REPORTING_YEAR = 2000
WATERMARK_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
RUN_MODE_FULL = "Volledig"
RUN_MODE_CHANGES = "Wijzigingen"
LOCAL_TIME_ZONE = "Europe/Amsterdam"
# Tables written by an accounting full run; every other table is skipped.
ACCOUNTING_FULL_WRITE_TABLES = ("Verkoopfacturen", "VerkoopOrders", "GrootboekMutaties")
# Columns of the accounting Divisions table that an upsert never overwrites.
DIVISION_OPERATOR_COLUMNS = ("Status", "Volledige_sync")
# ---------------------------------------------------------- END FIXED VALUES


def _lines(text: str) -> list[str]:
    return [ln.strip() for ln in text.strip().splitlines() if ln.strip()]


def _parse_targets(text: str) -> dict[str, list[tuple[str, str]]]:
    out: dict[str, list[tuple[str, str]]] = {}
    for ln in _lines(text):
        table, cols = ln.split(":", 1)
        out[table.strip()] = [(c.rsplit(":", 1)[0], c.rsplit(":", 1)[1])
                              for c in cols.split()]
    return out


TARGETS: dict[str, dict[str, list[tuple[str, str]]]] = {
    "accounting": _parse_targets(ACCOUNTING_TARGETS),
    "erp": _parse_targets(ERP_TARGETS),
    "payroll": _parse_targets(PAYROLL_TARGETS),
}


def target_types(source: str, table: str) -> list[tuple[str, str]] | None:
    """Ordered ``(column, reference type)`` pairs, ``None`` for an unknown table."""
    cols = TARGETS.get(source, {}).get(table)
    return list(cols) if cols is not None else None


def _parse_mappings(text: str) -> dict[str, dict[str, list[tuple[str, str]]]]:
    out: dict[str, dict[str, list[tuple[str, str]]]] = {}
    for ln in _lines(text):
        head, pairs = ln.split(":", 1)
        source, table = head.split()
        mapping = []
        for p in pairs.split(","):
            p = p.strip()
            src, _, dst = p.partition(">")
            mapping.append((src, dst or src))
        out.setdefault(source, {})[table] = mapping
    return out


COLUMN_MAPPINGS = _parse_mappings(MAPPINGS)


def column_mapping(source: str, table: str) -> list[tuple[str, str]] | None:
    """Ordered ``(source column, target column)`` pairs."""
    m = COLUMN_MAPPINGS.get(source, {}).get(table)
    return list(m) if m is not None else None


@dataclass(frozen=True)
class WriteConfig:
    """How a target table is cleared and written."""

    source: str
    table: str
    mode: str                      # none | truncate | reporting_year
    keys: tuple[str, ...] = ()
    tenant_column: str | None = None
    extra_tenant_columns: tuple[str, ...] = field(default=())


def _parse_write_configs(text: str) -> dict[tuple[str, str], WriteConfig]:
    src_names = {"accounting": "accounting", "ERP": "erp", "payroll": "payroll"}
    out = {}
    for ln in _lines(text):
        source, table, mode, keys, tenant = [c.strip() for c in ln.split("|")]
        keys_t = tuple() if keys in ("—", "-", "") else tuple(k.strip() for k in keys.split(","))
        tenants = [] if tenant in ("—", "-", "") else [t.strip() for t in tenant.split(",")]
        cfg = WriteConfig(src_names[source], table, mode, keys_t,
                          tenants[0] if tenants else None, tuple(tenants[1:]))
        out[(cfg.source, table)] = cfg
    return out


WRITE_CONFIG = _parse_write_configs(WRITE_CONFIGS)


def write_config(source: str, table: str) -> WriteConfig | None:
    return WRITE_CONFIG.get((source, table))


@dataclass(frozen=True)
class CatalogueEntry:
    source: str
    mode: str
    table: str
    filter_column: str | None
    filter_kind: str
    line_column: str | None


def _parse_catalogue(text: str) -> list[CatalogueEntry]:
    out = []
    for ln in _lines(text):
        head, rest = ln.split(":", 1)
        source, mode, table = head.split()
        parts = rest.split()
        col = None if parts[0] == "-" else parts[0]
        out.append(CatalogueEntry(source, mode, table, col, parts[1],
                                  parts[2] if len(parts) > 2 else None))
    return out


def _older_accounting(current: list[CatalogueEntry]) -> list[CatalogueEntry]:
    return [replace(e, source="accounting_o") for e in current if e.source == "accounting" and e.table not in OLDER_WITHOUT[e.mode]]


CATALOGUE_ENTRIES = _parse_catalogue(CATALOGUE)
CATALOGUE_ENTRIES += _older_accounting(CATALOGUE_ENTRIES) + _parse_catalogue(OLDER_ERP)


@dataclass(frozen=True)
class NestedDocument:
    table: str
    line_column: str
    prefix: str
    header_fields: tuple[str, ...]
    line_fields: tuple[str, ...]


def _parse_nested(text: str) -> dict[str, NestedDocument]:
    out = {}
    for ln in _lines(text):
        head, rest = ln.split(":", 1)
        table, line_col, prefix = head.split()
        hdr, lines = rest.split("|")
        out[table] = NestedDocument(table, line_col, prefix, tuple(hdr.split()), tuple(lines.split()))
    return out


NESTED = _parse_nested(NESTED_DOCUMENTS)


def projection(source: str, table: str) -> tuple[list[str], str | None, list[str]]:
    """The fields an extraction of the table reads - header fields, line list and line fields.

    A sales document's are its declared ones; any other table's are the source fields of its mapping.  A table without
    either is read whole (no header fields)."""
    base = source.removesuffix("_o")
    doc = NESTED.get(table) if base == "accounting" else None
    if doc is not None:
        return list(doc.header_fields), doc.line_column, list(doc.line_fields)
    m = column_mapping(base, table)
    return ([s for s, _ in m] if m else []), None, []
